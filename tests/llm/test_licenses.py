from __future__ import annotations

import random
from re import _parser as parser

from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import licenses, signatures

SCHEMA = "doc_id long, text string"
NAMES = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
DOCS = [
    (1, "Licensed under CC BY-NC 4.0. See the MIT License, and GNU General Public License version 3 or later"),
    (None, None), (2, ""), (2, ""), (3, "gpl gpl gpl-3.0 only; Apache   license apache license 2.0 " * 50), (4, "CC\nby"),
    (5, "ccby xcc by cc byé"), (6, "SPDX-License-Identifier: MIT"), (7, "the kmit license ümit license"), (8, "All rights reserved. mit\x01license"),
]


def test_rules_are_hundreds_in_order():
    found = licenses.rules()
    assert len(found) > 300 and [r["rank"] for r in found] == list(range(len(found)))


def test_scan_as_brute_force(spark):
    df = spark.createDataFrame(DOCS, SCHEMA).withColumn("norm", F.lit(1)).withColumn("id", F.lit(2))
    assert brute.rows(licenses.scan(df), *NAMES) == brute.licenses(DOCS, licenses.rules(), licenses.BASE)
    assert licenses.scan(df.limit(0)).count() == 0


def alternatives(pattern):
    """All texts that a rule's pattern stands for."""
    found = [""]
    for kind, value in pattern:
        kind = str(kind)
        if kind == "LITERAL":
            ways = [chr(value)]
        elif kind == "SUBPATTERN":
            ways = alternatives(value[3])
        elif kind == "BRANCH":
            ways = [w for branch in value[1] for w in alternatives(branch)]
        elif kind == "MAX_REPEAT":
            assert value[:2] == (0, 1)
            ways = ["", *alternatives(value[2])]
        elif kind == "IN":
            ways = [chr(v) for _, v in value]
        else:
            assert kind in ("ASSERT", "ASSERT_NOT"), kind
            ways = [""]
        found = [a + b for a in found for b in ways]
    return found


def ways(pattern):
    return alternatives(parser.parse(pattern.replace(signatures._NEXT, " the x")))


def test_every_alternative_has_its_rules_keyword():
    lacking = {(r["label"], r["keyword"], x) for r in licenses.rules() for x in ways(r["pattern"]) if r["keyword"] not in f" {x} "}
    assert not lacking
    # And what the first look at a text asks for.
    looks = lambda x: any(n in x for n in licenses._NEEDED) or any(n in x for n in licenses._SHORT)
    assert not {(r["label"], x) for r in licenses.rules() if r["label"] for x in ways(r["pattern"]) if not looks(x)}


def test_signatures_each_by_a_line_that_has_them_and_one_that_has_not(spark):
    known = [r for r in licenses.rules() if r["sure"] in (0.96, 0.97)]
    assert len(known) > 150 and len({r["pattern"] for r in known}) == len(known)
    lines = {i: ways(r["pattern"])[-1] for i, r in enumerate(known)}
    docs = [(i, f"Foo. {x.capitalize()}, bar") for i, x in lines.items()] + [(-1 - i, " ".join(reversed(x.split()))) for i, x in lines.items()]
    docs += [(10_000 + i, f"x {x.replace(r['keyword'].strip().split()[0], 'q')} y") for i, (x, r) in enumerate(zip(lines.values(), known, strict=True))]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(docs, SCHEMA)).collect()}
    for i, r in enumerate(known):
        assert any(d.label == r["label"] for d in got[i].detections), (r, lines[i], got[i])
        assert all(d.sure < 0.96 for d in got[-1 - i].detections), (r, got[-1 - i])
    want = brute.licenses(docs, licenses.rules(), licenses.BASE)
    assert sorted((tuple(r[n] for n in NAMES) for r in got.values()), key=str) == want


DENIED = {
    "This file is not licensed under the MIT License": "",
    "not licensed under the GNU LGPL version 3 but under the Apache License 2.0": "apache-2.0",
    "Unlike the Eclipse Public License, it is short. Code: MPL 2.0": "mpl-2.0",
    "no longer released under the Artistic License. See CDDL: common development and distribution license": "cddl",
    "It is incompatible with the WTFPL": "",
    "instead of the ISC License": "",
    "Not a font. Zlib License": "zlib",
    "licensed under the zlib license, not the wtfpl": "wtfpl,zlib",
}


def test_denials_hide_what_they_cover(spark):
    docs = list(enumerate(DENIED))
    rows = licenses.scan(spark.createDataFrame(docs, SCHEMA)).collect()
    # Base labels stay: they are counted apart.
    got = {r.doc_id: ",".join(x for x in r.labels.split(",") if x not in r.base_labels.split(",")) for r in rows}
    assert {text: got[i] for i, text in docs} == DENIED
    assert brute.rows(licenses.scan(spark.createDataFrame(docs, SCHEMA)), *NAMES) == brute.licenses(docs, licenses.rules(), licenses.BASE)


def test_base_columns_as_sql(spark):
    """Words, places and labels of the base phrases, which denials leave alone, from SQL."""
    import duckdb

    docs = DOCS + [(20 + i, x) for i, x in enumerate(DENIED)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    theirs = con.execute(BASE_SQL).fetchall()
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert brute.rows(licenses.scan(spark.createDataFrame(docs, SCHEMA)), *names) == sorted(theirs, key=str)


BASE_SQL = r"""
    with w as (
        select row_number() over () as r, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
        from documents
    ), p as (
        select string_split(phrase, ' ') as own, label
        from (values ('gnu general public license', 'gpl'), ('apache license', 'apache'), ('cc by', 'cc-by'), ('mit license', 'mit')) as t(phrase, label)
    ), places as (
        select r, i - 1 as word, label
        from (select r, words, own, label, unnest(range(1, len(words) - len(own) + 2)) as i from w, p)
        where words[i:i + len(own) - 1] = own
    )
    select doc_id, len(words), count(word), min(word), max(word), coalesce(string_agg(distinct label, ',' order by label), '')
    from w left join places using (r) group by r, doc_id, words"""


def test_plain_alternatives_as_ungated_brute_force(spark):
    ungated = [r | {"keyword": ""} for r in licenses.rules()]
    texts = [x for r in licenses.rules() if r["sure"] == 0.5 for x in alternatives(parser.parse(r["pattern"]))]
    docs = list(enumerate([*texts, "Simplified BSD License", "under the FreeBSD License.", "Original BSD and new BSD licence"]))
    got = brute.rows(licenses.scan(spark.createDataFrame(docs, SCHEMA)), *NAMES)
    assert got == brute.licenses(docs, ungated, licenses.BASE)
    labels = {r[0]: r[6] for r in got}
    assert [labels[i] for i, _ in docs[-3:]] == ["bsd-2-clause", "bsd-2-clause", "bsd,bsd-3-clause,bsd-4-clause"]


def test_detections_are_all_that_is_not_suppressed(spark):
    docs = [(1, "MIT License. x GPL y mit license"), (2, "wtfpl " * 1300), (3, "nothing"), (4, None)]
    got = {r.doc_id: [(d.start, d.end, d.label) for d in r.detections] for r in licenses.scan(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == {1: [(0, 2, "mit"), (3, 4, "gpl"), (5, 7, "mit")], 2: [(i, i + 1, "wtfpl") for i in range(1300)], 3: [], 4: []}


def test_random_overlaps(spark):
    pick = random.Random(2)
    words = "gnu general public license version 3 0 or later only apache 2 cc by nc sa mit spdx identifier licensed under the x".split()
    docs = [(i, " ".join(pick.choices(words, k=pick.randint(0, 60)))) for i in range(150)]
    docs += [(500 + i, " ".join([*pick.choices(words, k=3), "licensed under the gnu general public license version 3 or later", *pick.choices(words, k=3)])) for i in range(50)]
    df = spark.createDataFrame(docs, SCHEMA)
    assert brute.rows(licenses.scan(df), *NAMES) == brute.licenses(docs, licenses.rules(), licenses.BASE)


def test_a_text_with_very_many_detections(spark):
    text = "this work is licensed under the gnu general public license, version 3. " * 3000
    (row,) = licenses.scan(spark.createDataFrame([(1, text)], SCHEMA)).collect()
    assert (row.n_base, row.first_word, row.labels) == (3000, 6, "gpl,gpl-3.0")
