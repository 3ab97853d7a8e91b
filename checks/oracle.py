"""The same rows in SQL (DuckDB), written independently of the operators: joins and cases, no merges."""

from __future__ import annotations

from checks import fixtures as fx

_FIRST_AT, _AT = f"timestamp '{fx.FIRST_AT}'", f"timestamp '{fx.AT}'"

# The views of checks.fixtures.
VIEWS = {
    "fx_f_orders": """
        select o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as date) as order_date,
               o_orderstatus as order_status, o_orderdate as create_dt,
               o_orderdate + to_days(cast(o_orderkey % 30 as int)) as mdfctn_dt
        from orders""",
    "fx_f_order_items": """
        select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date)) as order_item_id,
               l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as decimal(12,2)) as quantity,
               cast(l_extendedprice as decimal(12,2)) as unit_price, cast(l_discount as decimal(12,2)) as discount,
               l_shipdate as create_dt, l_shipdate + to_days(l_linenumber) as mdfctn_dt
        from lineitem""",
    "fx_f_shippings": """
        select l_orderkey as order_id, l_linenumber as line_number, l_partkey as product_id, l_suppkey as supplier_id,
               l_shipdate as shipped_dt, l_linestatus as ship_status, l_shipdate as create_dt,
               l_shipdate + to_days(l_linenumber) as mdfctn_dt
        from lineitem""",
    "fx_f_payments": """
        select o_orderkey as payment_id, o_orderkey as order_id, cast(o_totalprice as decimal(12,2)) as amount,
               o_orderdate as create_dt, o_orderdate + to_days(cast(o_orderkey % 30 as int)) as mdfctn_dt
        from orders""",
    "fx_f_reviews": """
        select event_id as review_id, user_id as customer_id, event_type as topic, value as rating,
               ts as create_dt, ts + to_days(cast(event_id % 5 as int)) as mdfctn_dt
        from events""",
    "fx_d_customers": """
        select c_custkey as customer_id, c_name as name, c_mktsegment as segment, c_acctbal as balance, create_dt,
               create_dt + to_days(cast(c_custkey % 30 as int)) as mdfctn_dt
        from (select *, timestamp '1995-01-01' + to_days(c_nationkey) as create_dt from customer)""",
    "fx_d_products": """
        select p_partkey as product_id, p_name as name, p_brand as brand, p_type as category, p_retailprice as price,
               create_dt, create_dt + to_days(cast(p_partkey % 30 as int)) as mdfctn_dt
        from (select *, timestamp '1995-01-01' + to_days(p_size) as create_dt from part)""",
    "fx_d_categories": """
        select p_type as category, p_size as size_class, count(*) as product_count,
               timestamp '1995-01-01' + to_days(p_size) as create_dt,
               timestamp '1995-01-01' + to_days(p_size) + to_days(cast(min(p_partkey) % 30 as int)) as mdfctn_dt
        from part group by p_type, p_size""",
    "fx_lines": """
        select concat(lower(replace(p_brand, '#', '_')), '_', lower(p_type)) as line, count(*) as n,
               min(p_partkey) as first_part, min(p_size) as low, max(p_size) as high
        from part group by 1""",
    "fx_control": f"""
        select concat(layer, '-', line) as table_id, line as source_table_name, line as target_table_name,
               layer as target_layer_name, first_part % 7 <> 0 as active_flag, high % 5 = 0 as is_delete_flag,
               (n + step) % 3 = 0 as is_processed_flag,
               timestamp '1996-01-01' + to_days(low) as last_load_start_dt,
               timestamp '1996-01-01' + to_days(high) as last_load_end_dt,
               cast(null as bigint) as source_count, cast(null as bigint) as target_count,
               {_FIRST_AT} as dw_mdfctn_dt, '{fx.FIRST_LOAD}' as dw_load_id
        from fx_lines, (values (0, 'landing'), (1, 'bronze'), (2, 'silver'), (3, 'gold')) as l(step, layer)""",
    "fx_files": f"""
        select concat('bronze-', lower(replace(p_brand, '#', '_')), '_', lower(p_type)) as table_id,
               concat(lower(replace(p_brand, '#', '_')), '_', lower(p_type)) as table_name,
               concat('landing_files/', lower(replace(p_brand, '#', '_')), '_', lower(p_type), '/', p_partkey)
                   as file_path,
               timestamp '1996-01-01' + to_days(p_size) as delta_load_dt, {_FIRST_AT} as file_create_dt,
               p_partkey % 2 = 0 as is_processed_flag, '{fx.FIRST_LOAD}' as dw_load_id
        from part""",
    "fx_run_log": """
        select event_type as task_name, user_id as job_exec_dtl_id,
               case event_id % 3 when 0 then 'Started' when 1 then 'Success' else 'Failed' end as exec_status,
               ts, event_id
        from events""",
    "fx_runs": """
        select user_id as job_name, event_id as job_exec_id,
               case event_id % 3 when 0 then 'Started' when 1 then 'Success' else 'Failed' end as exec_status,
               ts as wf_start_datetime,
               case when event_id % 3 <> 0 then ts + to_days(cast(event_id % 11 as int)) end as wf_end_datetime
        from events""",
}
_NEEDS = {"fx_control": ["fx_lines"]}


def with_views(body: str, **more: str) -> str:
    """``body`` behind the views it or ``more`` names; ``more`` are extra named queries, in order."""
    text = body + " ".join(more.values())
    names = [v for v in VIEWS if v in text]
    names = [n for v in names for n in (*_NEEDS.get(v, []), v)]
    parts = {**{n: VIEWS[n] for n in names}, **more}
    return "with " + ", ".join(f"{n} as ({q})" for n, q in parts.items()) + " " + body


def between(column: str, first: str, last: str) -> str:
    return f"{column} between timestamp '{first}' and timestamp '{last}'"


def either(first: str, last: str, alias: str = "") -> str:
    return f"({between(alias + 'create_dt', first, last)} or {between(alias + 'mdfctn_dt', first, last)})"


def both(first: str, last: str) -> str:
    return f"({between('create_dt', first, last)} and {between('mdfctn_dt', first, last)})"


_DAY = ("1996-01-14 23:59:59", "1996-01-15 23:59:59")

_FACT = """
    select i.order_item_id, i.order_id, i.product_id, o.customer_id, o.order_date, o.order_status,
           i.quantity, i.unit_price, round(i.quantity * i.unit_price, 2) as gross_amount, i.discount,
           round(i.quantity * i.unit_price - i.discount, 2) as net_sales_amount, i.create_dt, i.mdfctn_dt
    from fx_f_order_items i join fx_f_orders o on i.order_id = o.order_id"""
_FACT_MONEY = ["quantity", "unit_price", "gross_amount", "discount", "net_sales_amount"]


def doubles(columns: list[str]) -> str:
    return "* replace (" + ", ".join(f"cast({c} as double) as {c}" for c in columns) + ")" if columns else "*"


def fact(first: str, last: str) -> str:
    return with_views(f"select {doubles(_FACT_MONEY)} from ({_FACT} where {either(first, last, 'i.')})")


def daily(where: str) -> str:
    """Averages in whole cents: half a cent goes up."""
    return f"""
        select order_date, n as total_orders, total_customers, cast(revenue as double) as total_revenue,
               cast(items as double) as total_items_sold,
               cast((2 * cast(revenue * 100 as hugeint) + n) // (2 * n) as double) / 100 as avg_order_value
        from (select o.order_date, count(distinct o.order_id) as n, count(distinct o.customer_id) as total_customers,
                     sum(i.quantity * i.unit_price - i.discount) as revenue, sum(i.quantity) as items
              from fx_f_order_items i join fx_f_orders o on i.order_id = o.order_id
              where {where} group by o.order_date)"""


def dates(first: str, last: str) -> str:
    def hit(column: str) -> str:
        return f"cast({column} as date) between date '{first[:10]}' and date '{last[:10]}'"

    return f"""
        select distinct o.order_date from fx_f_order_items i join fx_f_orders o on i.order_id = o.order_id
        where {hit('i.create_dt')} or {hit('i.mdfctn_dt')} or {hit('o.mdfctn_dt')}"""


_STORED = (
    f"{_FIRST_AT} as dw_create_dt, {_FIRST_AT} as dw_mdfctn_dt, '{fx.FIRST_LOAD}' as dw_load_id, "
    "cast(null as varchar) as dw_update_id"
)
_STAMP = (
    f"{_AT} as dw_create_dt, {_AT} as dw_mdfctn_dt, '{fx.LOAD}' as dw_load_id, cast(null as varchar) as dw_update_id"
)


def upsert(
    view: str, keys: list[str], values: list[str], window: tuple, mode: str, was: dict[str, str], money: list[str] = ()
) -> str:
    """Full outer join of what was stored and what is new; the new side wins where it is there."""
    first, loaded, last = window
    was = {"mdfctn_dt": "create_dt", **was}
    stored = f"select * replace ({', '.join(f'{v} as {c}' for c, v in was.items())}), {_STORED} from {view}"
    new = either(first, last) if mode == "either" else both(first, last)
    on = " and ".join(f"t.{k} = s.{k}" for k in keys)
    picked = [f"coalesce(t.{k}, s.{k}) as {k}" for k in keys]
    picked += [f"case when s.present then s.{c} else t.{c} end as {c}" for c in values]
    cast = {c: f"cast({c} as double) as {c}" for c in money}
    columns = ", ".join(cast.get(c, c) for c in [*keys, *values])
    return with_views(
        f"""
        select {columns}, dw_create_dt, dw_mdfctn_dt, dw_load_id, dw_update_id from (
            select {', '.join(picked)},
                   case when t.dw_create_dt is null then {_AT} else t.dw_create_dt end as dw_create_dt,
                   case when s.present then {_AT} else t.dw_mdfctn_dt end as dw_mdfctn_dt,
                   coalesce(t.dw_load_id, '{fx.LOAD}') as dw_load_id,
                   case when s.present and t.dw_load_id is not null then '{fx.LOAD}' end as dw_update_id
            from fresh s full outer join known t on {on})""",
        known=f"{stored} where create_dt < timestamp '{loaded}'",
        fresh=f"select *, true as present from {view} where {new}",
    )


_TIMES = ["create_dt", "mdfctn_dt"]
_ORDER_VALUES = ["customer_id", "order_date", "order_status", *_TIMES]
_ORDERS = ("fx_f_orders", ["order_id"], _ORDER_VALUES, fx.SALES_WINDOW)

_VERSIONS = f"""
    select customer_id, name, segment, balance, create_dt,
           case when balance < 0 then null when segment = 'AUTOMOBILE' then mdfctn_dt else create_dt end as mdfctn_dt,
           {_STORED}, timestamp '1995-01-01' as dw_eff_start_dt, cast(null as timestamp) as dw_eff_end_dt
    from fx_d_customers where segment not in ('MACHINERY', 'FURNITURE')
    union all
    select customer_id, name, segment, balance, create_dt, create_dt, {_STORED},
           timestamp '1995-01-01', timestamp '1995-01-02'
    from fx_d_customers where segment in ('HOUSEHOLD', 'FURNITURE')"""
_END = f"timestamp '{fx.DIMENSION_WINDOW[2]}'"
_CUSTOMERS_NEW = f"select * from fx_d_customers where {both(fx.DIMENSION_WINDOW[0], fx.DIMENSION_WINDOW[2])}"


def customers_after(condition: str) -> str:
    return with_views(
        f"select * from after where {condition}",
        versions=_VERSIONS,
        fresh=_CUSTOMERS_NEW,
        expired=f"""
            select t.* replace (
                case when x.customer_id is null then t.dw_eff_end_dt else {_END} end as dw_eff_end_dt,
                case when x.customer_id is null then t.dw_mdfctn_dt else {_AT} end as dw_mdfctn_dt,
                case when x.customer_id is null then t.dw_update_id else '{fx.LOAD}' end as dw_update_id)
            from versions t left join (
                select o.customer_id from versions o join fresh s on o.customer_id = s.customer_id
                where o.dw_eff_end_dt is null and o.mdfctn_dt <> s.mdfctn_dt
            ) x on t.customer_id = x.customer_id and t.dw_eff_end_dt is null""",
        after=f"""
            select * from expired
            union all
            select s.*, {_STAMP}, {_END}, null from fresh s
            where not exists (select 1 from expired t where t.customer_id = s.customer_id and t.dw_eff_end_dt is null)""",
    )


_LIVE = "active_flag and not is_delete_flag"
_LEFT = f"{_LIVE} and not is_processed_flag"
_DUE_BRONZE = "target_layer_name = 'bronze' and not is_processed_flag and active_flag"
_DUE_LANDING = "target_layer_name = 'landing' and not is_processed_flag and active_flag and not is_delete_flag"


def advanced(layers: str, start: str, end: str) -> str:
    hit = f"target_layer_name in ({layers}) and {_LIVE}"
    return with_views(f"""
        select * replace (
            case when {hit} then {start} else last_load_start_dt end as last_load_start_dt,
            case when {hit} then {end} else last_load_end_dt end as last_load_end_dt,
            case when {hit} then false else is_processed_flag end as is_processed_flag,
            case when {hit} then {_AT} else dw_mdfctn_dt end as dw_mdfctn_dt,
            case when {hit} then '{fx.LOAD}' else dw_load_id end as dw_load_id)
        from fx_control""")


def _outcome(run: str, table: str, layers: str) -> str:
    return f"""
        select '{run}' as run,
               case when n > 0 then 'Failed' else 'Success' end as exec_status,
               case when n > 0 then 'Listed tables remained unprocessed: ''' || names || ''''
                    else 'Workflow completed successfully.' end as status_message,
               case when n = 0 then a end as data_load_start_dt, case when n = 0 then b end as data_load_end_dt
        from (select count(*) filter (where {_LEFT} and {layers}) as n,
                     string_agg(target_table_name, ', ' order by target_table_name)
                         filter (where {_LEFT} and {layers}) as names,
                     max(last_load_start_dt) filter (where {_LIVE} and is_processed_flag) as a,
                     max(last_load_end_dt) filter (where {_LIVE} and is_processed_flag) as b
              from {table})"""


_MARKED = "target_layer_name = 'bronze' and last_load_end_dt <= timestamp '1996-02-15'"
_PRODUCTS_KNOWN = f"""
    select * replace (create_dt as mdfctn_dt), {_STORED}, timestamp '1995-01-01' as dw_eff_start_dt,
           case when create_dt < timestamp '1995-01-08' then timestamp '1995-01-09' end as dw_eff_end_dt
    from fx_d_products where create_dt < timestamp '{fx.DIMENSION_WINDOW[1]}'"""

ORACLE: dict[str, str] = {
    "daily_sales": with_views(daily("true")),
    "window_either": with_views(f"select * from fx_f_orders where {either(*fx.JANUARY)}"),
    "window_both": with_views(f"select * from fx_f_orders where {both(*fx.JANUARY)}"),
    "impacted_dates": with_views(dates(*fx.JANUARY)),
    "fact_sales_delta": fact(*fx.JANUARY),
    "fact_sales_day": fact(*_DAY),
    "daily_sales_refresh": with_views(
        f"""
        select t.*, {_STORED} from before t where t.order_date not in (select order_date from touched)
        union all
        select d.*, {_STAMP} from ({daily("true")}) d where d.order_date in (select order_date from touched)""",
        touched=dates(*_DAY),
        before=daily(f"i.create_dt < timestamp '{_DAY[0]}'"),
    ),
    "bronze_upsert": upsert(
        "fx_d_products",
        ["product_id"],
        ["name", "brand", "category", "price", *_TIMES],
        fx.DIMENSION_WINDOW,
        "either",
        {"name": "'?'"},
    ),
    "upsert_orders": upsert(*_ORDERS, "both", {"order_status": "'?'"}),
    "upsert_orders_either": upsert(*_ORDERS, "either", {"order_status": "'?'"}),
    "upsert_order_items": upsert(
        "fx_f_order_items",
        ["order_item_id"],
        ["order_id", "product_id", "quantity", "unit_price", "discount", *_TIMES],
        fx.SALES_WINDOW,
        "both",
        {"quantity": "0"},
        ["quantity", "unit_price", "discount"],
    ),
    "upsert_payments": upsert(
        "fx_f_payments",
        ["payment_id"],
        ["order_id", "amount", *_TIMES],
        fx.SALES_WINDOW,
        "both",
        {"amount": "0"},
        ["amount"],
    ),
    "upsert_reviews": upsert(
        "fx_f_reviews", ["review_id"], ["customer_id", "topic", "rating", *_TIMES], fx.REVIEW_WINDOW, "both", {"rating": "0"}
    ),
    "upsert_shippings": upsert(
        "fx_f_shippings", fx.SHIPPING_KEYS, ["ship_status", *_TIMES], fx.SALES_WINDOW, "both", {"ship_status": "'?'"}
    ),
    "upsert_categories": upsert(
        "fx_d_categories",
        ["category", "size_class"],
        ["product_count", *_TIMES],
        fx.DIMENSION_WINDOW,
        "both",
        {"product_count": "0"},
    ),
    "insert_absent_products": with_views(
        f"""
        select * from known
        union all
        select s.*, {_STAMP}, {_END}, null from fx_d_products s
        where {both(fx.DIMENSION_WINDOW[0], fx.DIMENSION_WINDOW[2])}
          and not exists (select 1 from known t where t.product_id = s.product_id and t.dw_eff_end_dt is null)""",
        known=_PRODUCTS_KNOWN,
    ),
    "scd2_customers": customers_after("true"),
    "scd2_current": customers_after("dw_eff_end_dt is null"),
    "append_customers": with_views(
        f"select * from versions union all select s.*, {_STAMP}, {_END}, null from fx_d_customers s", versions=_VERSIONS
    ),
    "pending_tables": with_views(f"""
        select * from fx_control
        where ({_DUE_LANDING}) or ({_DUE_BRONZE})
           or (target_layer_name in ('silver', 'gold') and not is_processed_flag and active_flag)"""),
    "pending_landing": with_views(f"""
        select b.table_id as bronze_table_id, b.target_table_name as bronze_table_name, a.*
        from (select * from fx_control where {_DUE_LANDING}) a
        join (select * from fx_control where target_layer_name = 'bronze') b
          on a.target_table_name = b.source_table_name"""),
    "unprocessed_tables": with_views(f"""
        select target_layer_name, count(*) as table_count,
               string_agg(target_table_name, ', ' order by target_table_name) as table_names
        from fx_control where {_LEFT} group by 1"""),
    "advance_window": advanced("'landing', 'bronze'", "last_load_end_dt", "timestamp '2024-01-31 23:59:59'"),
    "advance_window_given": advanced(
        "'silver', 'gold'", f"timestamp '{fx.JANUARY[0]}'", f"timestamp '{fx.JANUARY[1]}'"
    ),
    "mark_processed": with_views(f"""
        select * replace (
            case when {_MARKED} then true else is_processed_flag end as is_processed_flag,
            case when {_MARKED} then 10 else source_count end as source_count,
            case when {_MARKED} then 12 else target_count end as target_count,
            case when {_MARKED} then {_AT} else dw_mdfctn_dt end as dw_mdfctn_dt,
            case when {_MARKED} then '{fx.LOAD}' else dw_load_id end as dw_load_id)
        from fx_control"""),
    "load_range": with_views(f"""
        select max(last_load_start_dt) as load_start, max(last_load_end_dt) as load_end
        from fx_control where {_LIVE} and is_processed_flag"""),
    "run_outcome": with_views(
        _outcome("master", "fx_control", "true")
        + " union all "
        + _outcome("landing", "landed", "target_layer_name = 'landing'"),
        landed="""
            select * replace (is_processed_flag or target_layer_name = 'landing' as is_processed_flag)
            from fx_control""",
    ),
    "landing_file_pick": with_views(f"""
        select c.table_id, c.target_table_name, c.last_load_end_dt,
               (select min(f.file_path) from fx_files f
                where f.table_id = c.table_id and f.delta_load_dt = c.last_load_end_dt and not f.is_processed_flag)
                   as file_path
        from fx_control c where {_DUE_BRONZE}"""),
    "landing_file_register": with_views(
        f"""
        select f.table_id, f.table_name,
               case when w.line is null then f.file_path
                    else concat('landing_files/', w.line, '/', cast(w.last_load_end_dt as date)) end as file_path,
               case when w.line is null then f.delta_load_dt else w.last_load_end_dt end as delta_load_dt,
               case when w.line is null then f.file_create_dt else {_AT} end as file_create_dt,
               case when w.line is null then f.is_processed_flag else false end as is_processed_flag,
               case when w.line is null then f.dw_load_id else '{fx.LOAD}' end as dw_load_id
        from fx_files f left join written w on f.table_id = 'bronze-' || w.line""",
        written=f"select target_table_name as line, last_load_end_dt from fx_control where {_DUE_LANDING}",
    ),
    "latest_run": with_views("""
        select job_name, job_exec_id, exec_status, wf_start_datetime, wf_end_datetime from (
            select *, row_number() over (
                partition by job_name order by wf_end_datetime desc nulls last, job_exec_id desc) as place
            from fx_runs)
        where place = 1"""),
    "run_log_current": with_views("""
        select task_name, job_exec_dtl_id, exec_status, ts, event_id from (
            select *, row_number() over (
                partition by task_name, job_exec_dtl_id order by ts desc, event_id desc) as place
            from fx_run_log)
        where place = 1"""),
    "csv_landing_extract": with_views(f"select * from fx_f_orders where {either(*fx.JANUARY)}"),
}

# Merges of facts: the stored side is the whole fact as of the load before.
_M_FIRST, _M_LOADED, _M_LAST = fx.SALES_WINDOW
_FACT_VALUES = [
    "order_id", "product_id", "customer_id", "order_date", "order_status", *_FACT_MONEY, "create_dt", "mdfctn_dt",
]
VIEWS["fx_fact"] = _FACT
_NEEDS["fx_fact"] = ["fx_f_order_items", "fx_f_orders"]
ORACLE["fact_sales_merge"] = upsert(
    "fx_fact", ["order_item_id"], _FACT_VALUES, fx.SALES_WINDOW, "either", {"order_status": "'?'"}, _FACT_MONEY
)
ORACLE["upsert_order_items_probe"] = ORACLE["upsert_order_items_split"] = ORACLE["upsert_order_items"]
ORACLE["fact_sales_delta_orders"] = with_views(
    f"select {doubles(_FACT_MONEY)} from ({_FACT} where {either(*fx.JANUARY, 'i.')} or {between('o.mdfctn_dt', *fx.JANUARY)})"
)
ORACLE["insert_absent_repeated"] = with_views(
    f"""
    select * from known
    union all
    select s.*, {_STAMP}, {_END}, null from fx_d_products s
    where {both(fx.DIMENSION_WINDOW[0], fx.DIMENSION_WINDOW[2])} and (brand, category) not in (select (brand, category) from known)""",
    known=f"""
        select * replace (create_dt as mdfctn_dt), {_STORED}, timestamp '1995-01-01' as dw_eff_start_dt,
               cast(null as timestamp) as dw_eff_end_dt
        from fx_d_products where create_dt < timestamp '{fx.FEW_KNOWN}'""",
)
ORACLE["customer_surrogates"] = f"""
    select n as customer_sk, cast(1 as bigint) as versions, n > old as added
    from (select count(*) as total, count(*) filter (where dw_load_id <> '{fx.LOAD}') as old from ({ORACLE['scd2_customers']})),
         lateral (select unnest(range(1, total + 1)) as n)"""

VIEWS["fx_messages"] = "select *, case when exec_status = 'Started' then 'In Progress' end as status_message from fx_runs"
_NEEDS["fx_messages"] = ["fx_runs"]


def _ended(where: str, status: str, message: str) -> str:
    hit = f"exec_status = 'Started' and {where}"
    return with_views(f"""
        select * replace (case when {hit} then '{status}' else exec_status end as exec_status,
                          case when {hit} then {_AT} else wf_end_datetime end as wf_end_datetime,
                          case when {hit} then '{message}' else status_message end as status_message)
        from fx_messages""")


ORACLE["run_header_append"] = with_views(
    f"select * from fx_messages union all select -1, -1, 'Started', {_AT}, null, 'In Progress'"
)
ORACLE["run_close"] = _ended("wf_start_datetime < timestamp '2024-01-15'", "Success", "Workflow completed successfully.")
ORACLE["run_fail"] = _ended("job_name <= 40", "Failed", "There are failed jobs in the batch, Please check the logs.")
ORACLE["landing_file_mark"] = with_views(
    "select * replace (is_processed_flag or table_name like 'brand\\_1%' escape '\\' as is_processed_flag) from fx_files"
)
ORACLE["load_audit_counts"] = f"""
    select count(*) filter (where cast(dw_mdfctn_dt as date) = date '{fx.AT.date()}') as target_count,
           count(*) filter (where dw_load_id = '{fx.LOAD}') as insert_count,
           count(*) filter (where dw_update_id = '{fx.LOAD}') as update_count,
           count(*) filter (where dw_mdfctn_dt = {_AT}) as written_count
    from ({ORACLE['upsert_orders']})"""
ORACLE["upsert_order_items_bucketed"] = ORACLE["upsert_order_items_ranged"] = ORACLE["upsert_order_items"]
ORACLE["daily_sales_merged"] = ORACLE["daily_sales"]
ORACLE["daily_sales_refresh_partitions"] = ORACLE["daily_sales_refresh"]
ORACLE["csv_ragged_lines"] = with_views(
    """
    select case when order_id % 10 in (3, 7) then 'rejected' else 'loaded' end as outcome, order_status,
           count(*) as n, cast(sum(order_id) as bigint) as sum_of_ids
    from fx_f_orders group by 1, 2"""
)
ORACLE["run_log_appended"] = ORACLE["run_log_current"]
ORACLE["scd2_customers_one_pass"] = ORACLE["scd2_customers"]
