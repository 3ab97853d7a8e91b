"""Licence scans: ordered signature rules over normalised words, as DataFrame functions only.

A text is normalised to its words (letters, digits and all non-ASCII, A-Z lower-cased) with one blank in between.
Only texts with a word that some rule needs go on. Of the rules, only those whose keyword occurs are tried,
and each gives the word intervals where its pattern stands. Rules are ordered: an interval that lies within one
of an earlier rule is suppressed. Signatures written by hand (``signatures``) come before rules for the names of licences,
and denials (``not licensed under``, ``unlike``) before all: they have no label and only suppress. The labels of the intervals that remain are the text's labels, the
highest confidence among them is its score. Nothing is shuffled, as all of this is done within the row.

Suppression sweeps over the intervals by their start and only keeps those that still reach beyond it, and what remains
is gathered in blocks, so a text with very many detections takes time in proportion. The detections are all intervals that remain.

The base phrases are counted apart and their labels are never suppressed. Null text counts as empty and has no
words, labels or score; ids may be null or repeated.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.signatures import WORDS, signatures

# Phrases of the base scan and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"  # of a text whose A-Z are not yet lower-cased
_LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Licence families: label, keyword that every name contains, names in words as a pattern, versions.
FAMILIES = [
    ("gpl", " gnu general ", "gnu general public license", "1 2 3"),
    ("gpl", " gnu public ", "gnu public license", "1 2 3"),
    ("gpl", " gpl ", "gnu gpl|gpl", "1 2 3"),
    ("lgpl", " gnu lesser ", "gnu lesser general public license", "2 2.1 3"),
    ("lgpl", " gnu library ", "gnu library general public license", "2 2.1 3"),
    ("lgpl", " lgpl ", "gnu lgpl|lgpl", "2 2.1 3"),
    ("agpl", " affero ", "gnu affero general public license|affero general public license", "1 3"),
    ("agpl", " agpl ", "gnu agpl|agpl", "1 3"),
    ("gfdl", " documentation license ", "gnu free documentation license", "1.1 1.2 1.3"),
    ("apache", " apache ", "apache license|apache software license|apache public license", "1 1.1 2"),
    ("mpl", " mozilla ", "mozilla public license", "1 1.1 2"),
    ("mpl", " mpl ", "mpl", "1 1.1 2"),
    ("epl", " eclipse ", "eclipse public license", "1 2"),
    ("cddl", " distribution license ", "common development and distribution license", "1 1.1"),
    ("cpl", " common ", "common public license", "1"),
    ("eupl", " european ", "european union public licence", "1 1.1 1.2"),
    ("artistic", " artistic license ", "perl artistic license|artistic license", "1 2"),
    ("afl", " academic free license ", "academic free license", "1.1 2 2.1 3"),
    ("osl", " open software ", "open software license", "1 2 2.1 3"),
    ("bsl", " boost ", "boost software license", "1"),
    ("psf", " foundation license ", "python software foundation license", "2"),
    ("zpl", " zope ", "zope public license", "1 2 2.1"),
    ("ofl", " font license ", "sil open font license|open font license", "1 1.1"),
    ("odbl", " database ", "open data commons open database license|open database license", "1"),
    ("lppl", " project public license ", "latex project public license", "1 1.1 1.2 1.3"),
]
PLAIN = [
    ("mit", " mit ", "mit license|mit licence|mit expat license"),
    ("expat", " expat license ", "expat license"),
    ("isc", " isc ", "isc license|isc licence"),
    ("zlib", " zlib ", "zlib license|zlib libpng license"),
    ("unlicense", " unlicense ", "the unlicense|unlicense"),
    ("wtfpl", " wtfpl ", "wtfpl"),
    ("0bsd", " 0bsd ", "0bsd"),
    ("bsd-2-clause", " bsd ", "(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: license)?"),
    ("bsd-2-clause", " freebsd ", "freebsd(?: license)?"),
    ("bsd-3-clause", " bsd ", "(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd)(?: license)?"),
    ("bsd-4-clause", " bsd ", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?"),
    ("bsd", " bsd ", "bsd style license|bsd license|bsd licence"),
    ("public-domain", " public domain ", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("cc0", " cc0 ", "cc0(?: 1 0)?(?: universal)?"),
    ("mit", " hereby granted ", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", " permission to use ", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", " redistribution ", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("proprietary", " reserved ", "all rights reserved"),
]
CC_KINDS, CC_VERSIONS = ("", "nc", "nd", "sa", "nc nd", "nc sa"), "1 2 2.5 3 4"
_CC_WORDS = {"nc": "(?:nc|noncommercial|non commercial)", "nd": "(?:nd|noderivs|noderivatives|no derivatives)", "sa": "(?:sa|sharealike|share alike)"}
_GRANT = "(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?"
_SUFFIXES = {"or-later": " (?:or later|or any later version|or at your option any later version)", "only": " only", "": ""}


def rules() -> list[dict[str, object]]:
    """All rules, the first in order first: label, keyword, pattern, confidence.

    Signatures come first: denials, which have no label, exceptions, and what licences and notices say in their own
    words. Then names: a tagged identifier comes before a grant of a version, that before the version's mere name, a grant
    without version before a mere name. Within a kind, longer patterns come first.
    """
    found = signatures()
    for label, keyword, names, versions in FAMILIES:
        name = f"(?:{names})"
        for version, (suffix, words) in product(versions.split(), _SUFFIXES.items()):
            number = version.replace(".", " ") + ("(?: 0)?" if "." not in version else "")
            full = "-".join(x for x in (label, version if "." in version else f"{version}.0", suffix) if x)
            found.append((0, full, " spdx ", f"spdx license identifier {label} {number}{words}", 0.99))
            found.append((1, full, keyword, f"{_GRANT}{name} (?:version |v )?v?{number}{words}", 0.95))
            found.append((2, full, keyword, f"{name} (?:version |v )?v?{number}{words}", 0.85))
        found.append((3, label, keyword, f"{_GRANT}{name}", 0.7))
        found.append((4, label, keyword, name, 0.5))
    for kind, version in product(CC_KINDS, CC_VERSIONS.split()):
        number = version.replace(".", " ") + ("(?: 0)?" if "." not in version else "")
        parts = "".join(f" {_CC_WORDS[x]}" for x in kind.split())
        full = "-".join(x for x in ("cc-by", kind.replace(" ", "-"), version if "." in version else f"{version}.0") if x)
        found.append((0, full, " spdx ", f"spdx license identifier cc by{parts} {number}", 0.99))
        found.append((1, full, " cc by ", f"{_GRANT}cc by{parts} {number}", 0.95))
        found.append((2, full, " cc by ", f"cc by{parts} {number}", 0.85))
        found.append((2, full, " creative commons ", f"creative commons attribution{parts} {number}(?: international| unported)?", 0.85))
    for kind in CC_KINDS:
        parts = "".join(f" {_CC_WORDS[x]}" for x in kind.split())
        full = "-".join(x for x in ("cc-by", kind.replace(" ", "-")) if x)
        found.append((4, full, " cc by ", f"cc by{parts}", 0.5))
        found.append((4, full, " creative commons ", f"creative commons attribution{parts}", 0.5))
    for label, keyword, pattern in PLAIN:
        found.append((0, label, " spdx ", f"spdx license identifier {label.replace('-', ' ')}", 0.99))
        found.append((3, label, keyword, f"{_GRANT}(?:{pattern})", 0.7))
        found.append((4, label, keyword, f"(?:{pattern})", 0.5))
    ordered = sorted(found, key=lambda r: (r[0], -len(r[3]), r[3], r[1]))
    return [{"rank": i, "label": r[1], "keyword": r[2], "pattern": f"(?<= )(?:{r[3]})(?= )", "sure": r[4]} for i, r in enumerate(ordered)]


# Every rule needs one of these in the lower-cased text as it stands, or one of the short names as a word of its own.
_NEEDED = ("licen", "permission", "spdx", "creative", "domain", "clause", "wtfpl", "0bsd", "hereby", "reserved", "bsd", *WORDS)
_SHORT = ("cc", "gpl", "mpl")
_SHORT_WORDS = r"(?<![0-9a-z\x{80}-\x{10FFFF}])(?:cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by|cc0|[al]?gpl|mpl)(?![0-9a-z\x{80}-\x{10FFFF}])"


_BLOCK = 512  # detections that are appended one by one before they are put away


def _intervals(norm: Column, pattern: Column) -> Column:
    """First word and the word after the last of every place where the pattern stands."""
    marked = F.split(F.trim(F.regexp_replace(norm, pattern, F.lit("\x01$0\x02"))), " ")

    def of_words(words: Column) -> Column:
        place = F.sequence(F.lit(0), F.size(words) - 1)
        begins = F.filter(place, lambda i: F.startswith(F.get(words, i), F.lit("\x01")))
        ends = F.filter(place, lambda i: F.endswith(F.get(words, i), F.lit("\x02")))
        return F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("start"), (e + 1).alias("end")))

    # As an element of an array the words are computed once, not once per place.
    return F.get(F.transform(F.array(marked), of_words), F.lit(0))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels (comma-joined), score, detections."""
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    # One step after the other, so that what is used several times is computed once.
    split = docs.select(F.col(id_col).alias("id"), text).select(
        "id", "text", F.lower("text").alias("low"), F.split("text", _ANY_SEPARATORS).alias("parts")
    )
    some = lambda words: reduce(lambda a, b: a | b, [F.contains("low", F.lit(w)) for w in words])
    needs = some(_NEEDED) | (some(_SHORT) & F.col("low").rlike(_SHORT_WORDS))
    # The part before a separator that leads, and that after one that trails, are empty and no words.
    empty_ends = (F.element_at("parts", 1) == "").cast("int") + ((F.size("parts") > 1) & (F.element_at("parts", -1) == "")).cast("int")
    words = split.select("id", "text", (F.size("parts") - empty_ends).cast("long").alias("n_words"), needs.alias("needs"))
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate("text", *_LETTERS), _SEPARATORS, " ")), F.lit(" "))
    normal = words.select("id", "n_words", F.when(F.col("needs"), spaced).alias("norm"))

    norm = F.col("norm")
    base = F.array(*[F.struct(F.lit(p).alias("phrase"), F.lit(label).alias("label")) for p, label in BASE.items()])
    places = F.transform(
        F.filter(base, lambda b: F.contains(norm, F.concat(F.lit(" "), b["phrase"], F.lit(" ")))),
        lambda b: F.struct(
            b["label"].alias("label"),
            F.transform(_intervals(norm, F.concat(F.lit("(?<= )"), b["phrase"], F.lit("(?= )"))), lambda x: x["start"]).alias("starts"),
        ),
    )
    kind = "array<struct<keyword:string,rules:array<struct<rank:int,label:string,keyword:string,pattern:string,sure:double>>>>"
    ordered = rules()
    words_of_rules = dict.fromkeys(r["keyword"] for r in ordered)
    grouped = [{"keyword": k, "rules": [r for r in ordered if r["keyword"] == k]} for k in words_of_rules]
    table = F.from_json(F.lit(json.dumps(grouped)), kind)
    open_groups = F.filter(table, lambda g: F.contains(norm, g["keyword"]))
    tried = F.filter(F.flatten(F.transform(open_groups, lambda g: g["rules"])), lambda r: F.rlike(norm, r["pattern"]))
    hits = F.flatten(
        F.transform(
            tried,
            lambda r: F.transform(
                _intervals(norm, r["pattern"]),
                lambda x: F.struct(
                    x["start"].alias("start"), (-x["end"]).alias("back"), r["rank"].alias("rank"), r["label"].alias("label"), r["sure"].alias("sure")
                ),
            ),
        )
    )
    found = normal.select(
        "id", "n_words", F.when(norm.isNotNull(), places).alias("base"), F.when(norm.isNotNull(), F.sort_array(hits)).alias("hits")
    )

    nothing = F.struct(
        F.array().cast("array<struct<back:int,rank:int>>").alias("reach"),
        F.array().cast("array<array<struct<start:int,end:int,label:string,sure:double>>>").alias("blocks"),
        F.array().cast("array<struct<start:int,end:int,label:string,sure:double>>").alias("kept"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("score"),
    )

    def sweep(state: Column, hit: Column) -> Column:
        within = F.exists(state["reach"], lambda e: (e["back"] <= hit["back"]) & (e["rank"] < hit["rank"]))
        still = F.filter(state["reach"], lambda e: -e["back"] > hit["start"])
        within = within | (hit["label"] == "")  # a denial hides others and is none itself
        new = ~within & ~F.array_contains(state["labels"], hit["label"])
        full = F.size(state["kept"]) >= _BLOCK
        span = F.struct(hit["start"].alias("start"), (-hit["back"]).alias("end"), hit["label"].alias("label"), hit["sure"].alias("sure"))
        return F.struct(
            F.concat(still, F.array(F.struct(hit["back"].alias("back"), hit["rank"].alias("rank")))).alias("reach"),
            F.when(full, F.concat(state["blocks"], F.array(state["kept"]))).otherwise(state["blocks"]).alias("blocks"),
            F.concat(F.when(full, F.slice(state["kept"], 1, 0)).otherwise(state["kept"]), F.filter(F.array(span), lambda _: ~within)).alias("kept"),
            F.when(new, F.concat(state["labels"], F.array(hit["label"]))).otherwise(state["labels"]).alias("labels"),
            F.when(within, state["score"]).otherwise(F.greatest(state["score"], hit["sure"])).alias("score"),
        )

    starts = F.flatten(F.transform("base", lambda b: b["starts"]))
    base_labels = F.transform("base", lambda b: b["label"])
    swept = found.select(
        "id", "n_words", F.coalesce(starts, F.array().cast("array<int>")).alias("starts"),
        F.coalesce(base_labels, F.array().cast("array<string>")).alias("base_labels"),
        F.aggregate(F.coalesce("hits", F.array().cast(found.schema["hits"].dataType)), nothing, sweep).alias("state"),
    )
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return swept.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        joined(F.col("base_labels")).alias("base_labels"),
        joined(F.concat("base_labels", "state.labels")).alias("labels"),
        F.col("state.score").alias("score"),
        F.flatten(F.concat("state.blocks", F.array("state.kept"))).alias("detections"),
    )
