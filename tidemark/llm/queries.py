"""The queries of this folder: (spark, folder of the given tables) to a DataFrame, and SQL for some of them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, extract, forest, licenses, neardup, phrases, quotes, repeats, toxicity, trie, urlfilter, warc
from tidemark.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.deduplicated_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severities(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def q_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quotes.conversations(table(spark, sf_dir, "conversations"))
    return found.withColumn("replies_to", F.array_join(F.col("replies_to").cast("array<string>"), ","))


RULES = [
    urlfilter.Rule("net/", "block"),
    urlfilter.Rule("example.net/en/", "allow"),
    urlfilter.Rule("example.com/de/", "block"),
    urlfilter.Rule("org/fr/", "allow"),
]


def q_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), RULES)


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("detections")


def q_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def q_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), path=VOCABULARY, pattern=public_tokenizers.PATTERN)


def q_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed, (F.col("n_hit") > 0).alias("contaminated"))


def q_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=4, support=30, best=2000)


def q_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, sizes = trie.rebuilt(trie.numbered(table(spark, sf_dir, "conversations")), every=5, most=9)
    return trie.prefix_trie(turns, sizes).drop("node", "parent")


def q_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), spans, F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_revisits": q_warc,
    "op2_quotation_linking": q_quotes,
    "op3_url_filters": q_urls,
    "op4_byte_bpe": q_bpe,
    "op5_toxicity": q_toxicity,
    "op6_minhash_near_dedup": q_near_duplicates,
    "op7_license_scan": q_licenses,
    "op8_html_extraction": q_extraction,
    "op9_benchmark_decontamination": q_decontamination,
    "op10_nearest_neighbours": q_neighbours,
    "op11_phrase_collocations": q_phrases,
    "op12_conversation_trie": q_trie,
    "op13_suffix_array_dedup": q_repeats,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# 20 bits of the digest at a time, as four digits of five bits.
_BASE32 = " || ".join(
    f"substr('{_DIGITS}', ((cast('0x' || substr(sha1(payload), {5 * i + 1}, 5) as bigint) >> {shift}) & 31)::int + 1, 1)"
    for i in range(8)
    for shift in (15, 10, 5, 0)
)
_RULE_ROWS = ", ".join(f"('{r.text}', '{r.verdict}')" for r in RULES)

ORACLE: dict[str, str] = {
    "op1_warc_revisits": f"""
        with p as (
            select page_id, coalesce(html, '') as payload,
                   min(page_id) over (partition by coalesce(html, '')) as first_id
            from pages
        )
        select page_id, strlen(payload) as payload_bytes, {_BASE32} as payload_digest,
               case when page_id = first_id then 'response' else 'revisit' end as record_type,
               case when page_id <> first_id then first_id end as refers_to
        from p""",
    "op6_minhash_near_dedup": rf"""
        with recursive w as (
            select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as words from documents
        ), s as (
            select distinct doc_id, case when len(words) < 2 then words[1] else words[i] || ' ' || words[i + 1] end as shingle
            from (select doc_id, words, unnest(range(1, greatest(len(words), 2))) as i from w where len(words) > 0)
        ), n as (
            select doc_id, count(*) as n from s group by doc_id
        ), shared as (
            select a.doc_id as a, b.doc_id as b, count(*) as m
            from s a join s b using (shingle) where a.doc_id <> b.doc_id group by all
        ), links as (
            select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * m >= 80 * (x.n + y.n - m)
        ), reach as (
            select doc_id, doc_id as other from documents
            union
            select r.doc_id, l.b from reach r join links l on r.other = l.a
        )
        select doc_id, coalesce(n, 0) as n_shingles, min(other) as component_id, doc_id = min(other) as kept
        from reach left join n using (doc_id) group by doc_id, n""",
    "op8_html_extraction": r"""
        with a as (
            select page_id, url, regexp_extract(html, '<article>((?s).*)</article>', 1) as inner_html from pages
        ), t as (
            select page_id, url,
                   regexp_replace(regexp_replace(inner_html, '</?b>', '', 'g'), '</?(p|h1|br)>', ' ', 'g') as spaced
            from a
        ), u as (
            select page_id, url,
                   replace(replace(replace(replace(spaced, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)) as freed
            from t
        )
        select page_id, url, text, length(text) as n_chars
        from (select page_id, url, trim(regexp_replace(regexp_replace(freed, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) as text from u)""",
    "op2_quotation_linking": r"""
        with recursive m as (
            select row_number() over () as r, conv_id, turn, role, coalesce(text, '') as text from conversations
        ), raw as (
            select r, unnest(parts) as line, unnest(range(1, len(parts) + 1)) as i
            from (select r, regexp_split_to_array(text, '\r\n|\r|\n') as parts from m)
        ), marked as (
            select r, i, length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)*'), '[^>]', '', 'g')) as depth,
                   regexp_replace(line, '^(?:[ \t]*>)+[ \t]?', '') as body
            from raw
        ), levelled as (
            select r, i, body,
                   case when depth = 0 and lead(depth, 1, 0) over (partition by r order by i) > 0
                             and regexp_matches(body, '(?i)^.{0,300}\b(?:wrote|writes|said|schrieb|a écrit|escribió)\b.{0,100}:\s*$')
                        then -1 else depth end as level
            from marked
        ), stepped as (
            select *, case when level <> lag(level) over (partition by r order by i) then 1 else 0 end as step from levelled
        ), numbered as (
            select *, sum(step) over (partition by r order by i) as passage from stepped
        ), passages as (
            select r, passage, level, string_agg(body, chr(10) order by i) as body from numbered group by all
        ), own as (
            select r, regexp_replace(coalesce(string_agg(body, chr(10) order by passage) filter (where level = 0), ''),
                                     '^\s+|\s+$', '', 'g') as own,
                   count(*) filter (where level > 0 and regexp_matches(body, '\S')) as n_quotes
            from passages group by r
        ), texts as (
            select r, passage, level, body from passages where level >= 0
            union all
            select r, -1, 0, own from own
        ), paragraphs as (
            select r, passage, level, unnest(regexp_split_to_array(body, '\n\s*\n')) as paragraph from texts
        ), parts as (
            select r, passage, level, 0 as grain, '' as paragraph, body as part from texts
            union all
            select r, passage, level, 1, paragraph, paragraph from paragraphs
            union all
            select r, passage, level, 2, paragraph, unnest(string_split(paragraph, chr(10))) from paragraphs
        ), units as (
            select r, passage, level, grain, lower(trim(regexp_replace(paragraph, '\s+', ' ', 'g'))) as paragraph,
                   lower(trim(regexp_replace(part, '\s+', ' ', 'g'))) as unit
            from parts
        ), originals as (
            select conv_id, unit, min(turn) as original
            from units join m using (r) where level = 0 and unit <> '' group by conv_id, unit
        ), found as (
            select r, conv_id, turn, passage, level, grain, original, min(grain) over (partition by r, passage) as best,
                   min(grain) over (partition by r, passage, grain = 0, paragraph) as best_here
            from units join m using (r) join originals using (conv_id, unit) where level > 0 and unit <> '' and original < turn
        ), links as (
            select r, conv_id, turn, passage, level, original from found where grain = 0 or best > 0 and grain = best_here
        ), lowest as (
            select r, min(level) as level, count(distinct passage) as n_linked from links group by r
        ), replies as (
            select r, conv_id, turn, n_linked, list_sort(list_distinct(list(original))) as replies_to
            from links join lowest using (r, level) group by r, conv_id, turn, n_linked
        ), parents as (
            select conv_id, turn, max(replies_to[len(replies_to)]) as parent from replies group by conv_id, turn
        ), chains as (
            select conv_id, turn, parent as thread, 1 as depth from parents
            union all
            select c.conv_id, c.turn, p.parent, c.depth + 1
            from chains c join parents p on c.conv_id = p.conv_id and c.thread = p.turn
        ), ends as (
            select conv_id, turn, first(thread order by depth desc) as thread, max(depth) as depth from chains group by conv_id, turn
        )
        select m.conv_id, m.turn, m.role, own as text,
               case when m.conv_id is not null then coalesce(ends.thread, m.turn) end as thread, coalesce(ends.depth, 0) as depth,
               replies_to[len(replies_to)] as reply_to, coalesce(array_to_string(replies_to, ','), '') as replies_to,
               n_quotes, coalesce(n_linked, 0) as n_linked,
               '<|' || coalesce(m.role, 'unknown') || '|>' || chr(10) || own || chr(10) as formatted
        from m join own using (r) left join replies using (r) left join ends on ends.conv_id = m.conv_id and ends.turn = m.turn""",
    "op3_url_filters": rf"""
        with rests as (
            select row_number() over () as r, page_id,
                   case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages
        ), hosts as (
            select r, page_id, rest, regexp_extract(rest, '^[^/?#]*') as host from rests
        ), parts as (
            select r, page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') as path
            from hosts
        ), rules as (
            select rule, verdict, split_part(rule, '/', 1) as of_host, substr(rule, strpos(rule, '/')) as of_path
            from (values {_RULE_ROWS}) as r(rule, verdict)
        )
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
        from parts left join rules
          on (host = of_host or ends_with(host, '.' || of_host)) and starts_with(path, of_path)
        qualify row_number() over (partition by r order by length(rule) desc, rule) = 1""",
    "op9_benchmark_decontamination": rf"""
        with w as (
            select row_number() over () as r, doc_id, {_ALNUM.format(f"coalesce({_LOWER}, '')")} as words from documents
        ), i as (
            select item_id, {_ALNUM.format(f"coalesce({_LOWER}, '')")} as words from benchmark
        ), passages as (
            select distinct item_id, size, array_to_string(words[place:place + size - 1], ' ') as passage
            from (select item_id, words, least(10, len(words)) as size,
                         unnest(range(1, len(words) - least(10, len(words)) + 2)) as place
                  from i where len(words) > 0)
        ), places as (
            select r, size, place, array_to_string(words[place:place + size - 1], ' ') as passage
            from (select r, words, size, unnest(range(1, len(words) - size + 2)) as place
                  from w, (select distinct size from passages) where len(words) >= size)
        ), hits as (
            select r, place, size, item_id from places join passages using (size, passage)
        ), covered as (
            select r, count(distinct word) as n_hit
            from (select r, unnest(range(place, place + size)) as word from hits) group by r
        ), listed as (
            select r, count(distinct item_id) as n_items,
                   string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as items
            from hits group by r
        )
        select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from w left join covered using (r) left join listed using (r)""",
    "op11_phrase_collocations": rf"""
        with p as (
            select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(coalesce({_LOWER}, ''), '[.,;:!?\x0A-\x0D]')) as piece from documents
        ), w as (
            select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from p
        ), totals as (
            select lang, cast(sum(len(words)) as bigint) as n from w group by lang
        ), places as (
            select lang, words, size, unnest(range(1, len(words) - size + 2)) as place from w, (values (1), (2), (3), (4)) as s(size)
        ), f as (
            select lang, array_to_string(words[place:place + size - 1], ' ') as phrase, size, count(*) as a
            from places group by all having count(*) >= 30
        ), cuts as (
            select lang, phrase, size, a, k, string_split(phrase, ' ') as words
            from (select *, unnest(range(1, size)) as k from f where size > 1)
        ), scored as (
            select c.lang, c.phrase, c.a, k, l.a as l, r.a as r, cast(2000000 * c.a::hugeint // (l.a + r.a) as bigint) as score
            from cuts c join f l on l.lang = c.lang and l.phrase = array_to_string(words[1:k], ' ')
                        join f r on r.lang = c.lang and r.phrase = array_to_string(words[k + 1:], ' ')
            qualify row_number() over (partition by c.lang, c.phrase order by score, k) = 1
        ), inner_words as (
            select lang, array_to_string(words[start:start + m - 1], ' ') as phrase, max(a) as longer
            from (select *, unnest(range(1, size - m + 2)) as start
                  from (select lang, string_split(phrase, ' ') as words, size, a, unnest(range(2, size)) as m from f where size > 2))
            group by all
        )
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
        from scored left join inner_words using (lang, phrase) join totals using (lang)
        where longer is null or 100 * longer < 80 * a
        qualify rank <= 2000""",
    "op12_conversation_trie": r"""
        with t as (
            select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                   row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as depth
            from conversations where conv_id is not null
        ), bits as (
            select conv_id, count(*) as n,
                   flatten(list_transform(range(1, length(conv_id::varchar) + 1), lambda i: [ascii(substr(conv_id::varchar, i, 1)), 0, 0, 0, 0, 0, 0, 0])) as xs
            from t group by conv_id
        ), c as (
            select conv_id, n, conv_id - conv_id % 5 as base, xor(list_reduce(list_prepend(4294967295::bigint, xs::bigint[]),
                   lambda a, x: case when xor(a, x) % 2 = 1 then xor(xor(a, x) >> 1, 3988292384) else xor(a, x) >> 1 end), 4294967295) % 9 as h
            from bits
        ), d as (
            select c.conv_id, c.n, c.base, c.h, least(c.h, coalesce(b.n, 0)) as taken from c left join c b on b.conv_id = c.base
        ), rebuilt as (
            select conv_id, depth - h + taken as depth, role, text from t join d using (conv_id) where depth > h
            union all
            select d.conv_id, depth, role, text from t join d on t.conv_id = d.base where depth <= taken
        ), paths as (
            select conv_id, depth, strlen(text) as bytes,
                   sha256(string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '')
                          over (partition by conv_id order by depth rows unbounded preceding)) as node
            from rebuilt
            union all
            select conv_id, 0, 0, '' from d
        ), linked as (
            select *, lag(node) over (partition by conv_id order by depth) as parent,
                   depth = max(depth) over (partition by conv_id) as last
            from paths
        ), nodes as (
            select node, any_value(parent) as parent, min(conv_id) as conv_id, any_value(depth) as depth, count(*) as n_convs,
                   (count(*) - 1) * any_value(bytes) as own,
                   coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where last), '') as ends
            from linked group by node
        ), children as (
            select parent as node, count(*) as n_children from nodes where parent is not null group by parent
        ), sums as (
            select p.node, cast(sum(x.own) as bigint) as saved_tokens, count(*) filter (where n_children is null) as n_leaves
            from nodes x left join children using (node) join paths p on p.conv_id = x.conv_id and p.depth <= x.depth
            group by p.node
        )
        select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens,
               sha256(n.ends) as ends_sha256
        from nodes n left join nodes p on p.node = n.parent left join children on children.node = n.node join sums on sums.node = n.node""",
    "op13_suffix_array_dedup": r"""
        with d as (
            select row_number() over () as r, doc_id, strlen(coalesce(text, '')) as n, hex(coalesce(text, '')) as digits from documents
        ), pieces as (
            select r, doc_id, k, substr(digits, 1000 * k + 1, 1098) as piece
            from (select r, doc_id, digits, unnest(range(0, n // 500 + 1)) as k from d)
        ), windows as (
            select r, doc_id, 500 * k + i as p, substr(piece, 2 * i + 1, 100) as bytes
            from (select r, doc_id, k, piece, unnest(range(0, length(piece) // 2 - 49)) as i from pieces)
        ), firsts as (
            select bytes, min(coalesce(doc_id, 9223372036854775807)) as first from windows group by bytes
        ), stepped as (
            select r, p, case when p - lag(p) over (partition by r order by p) <= 50 then 0 else 1 end as step
            from windows join firsts using (bytes) where first < coalesce(doc_id, 9223372036854775807)
        ), spans as (
            select r, min(p) as low, max(p) + 50 as high
            from (select r, p, sum(step) over (partition by r order by p) as span from stepped) group by r, span
        ), gaps as (
            select r, low, high, substr(digits, 2 * coalesce(lag(high) over w, 0) + 1, 2 * (low - coalesce(lag(high) over w, 0))) as gap
            from spans join d using (r) window w as (partition by r order by low)
        ), cut as (
            select r, cast(sum(high - low) as bigint) as n_removed, count(*) as n_spans, max(high) as last,
                   string_agg(gap, '' order by low) as gaps
            from gaps group by r
        )
        select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
               sha256(unhex(coalesce(gaps, '') || substr(digits, 2 * coalesce(last, 0) + 1))) as kept_sha256
        from d left join cut using (r)""",
}
