"""URL rules as glob patterns, matched all at once by a multiword Shift-And automaton.

Every pattern takes one bit for its start and one per character; all patterns lie side by side in as
many 64-bit words as they need. A step for a character shifts all words by one bit, with the carry from
word to word, keeps the bits whose character it is, and keeps those that stand before a ``*``, which takes
any character. After the last character, the bits at pattern ends say which patterns fit the whole URL.
One step serves all URLs of a batch.

A URL is matched in canonical form: host, a mark that no wildcard crosses, path. The host is what stands
between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; the path is what
follows, up to ``?``, ``#`` or the end. A null URL or one without ``://`` has an empty host and path, and is
judged like any other. A rule is a host and a path, written together (``example.net/en/``); it fits the
host and all its subdomains if the path starts with the rule's, hence is two patterns. In both parts ``*``
takes any characters and ``?`` one. The longest rule that fits wins; of equally long ones, the first in the alphabet.
Every row is judged, so rows that repeat a page id, or are alike, all have a row in the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ready_for_python

MARK = "\U0010ffff"  # no character; a URL's own is replaced
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_AT_ONCE = 1 << 22  # characters of a batch held as numbers


@dataclass(frozen=True)
class Rule:
    text: str  # host and path, ``net/``
    verdict: str

    def patterns(self) -> list[str]:
        host, slash, path = self.text.partition("/")
        host = host.translate(_LOWER)
        return [f"{front}{host}{MARK}{slash}{path}*" for front in ("", "*.")]


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in (rest.find("/"), rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in (path.find("?"), path.find("#")) if i >= 0), default=len(path))
    return rest[:end].translate(_LOWER), path[:stop]


class Automaton:
    def __init__(self, patterns: Sequence[str]):
        letters = sorted({c for p in patterns for c in p if c not in "*?"} | {MARK})
        self.codes = np.array([ord(c) for c in letters], dtype=np.uint32)
        starts, ends, takes, stays = [], [], [], []  # per bit: the kinds of characters it takes, and whether it stays
        for pattern in patterns:
            starts.append(len(takes))
            takes.append(None)
            stays.append(False)
            for c in pattern:
                if c == "*":
                    stays[-1] = True
                else:
                    takes.append(c)
                    stays.append(False)
            ends.append(len(takes) - 1)
        self.words = (len(takes) + 63) // 64 or 1
        kinds = len(letters) + 1  # the last: every other character
        take, stay = np.zeros((kinds, len(takes)), dtype=bool), np.zeros((kinds, len(takes)), dtype=bool)
        mark = letters.index(MARK)
        for bit, c in enumerate(takes):
            if c == "?":
                take[:, bit] = np.arange(kinds) != mark
            elif c is not None:
                take[letters.index(c), bit] = True
            stay[:, bit] = stays[bit] & (np.arange(kinds) != mark)
        self.take, self.stay = self._packed(take), self._packed(stay)
        first = np.zeros((1, len(takes)), dtype=bool)
        first[0, starts] = True
        self.first = self._packed(first)[0]
        self.ends = np.array(ends, dtype=np.uint64)

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bits), self.words), dtype=np.uint64)
        for bit in range(bits.shape[1]):
            out[:, bit // 64] |= bits[:, bit].astype(np.uint64) << np.uint64(bit % 64)
        return out

    def fits(self, texts: Sequence[str]) -> np.ndarray:
        """Which pattern (column) fits which whole text (row)."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)
        place = np.searchsorted(self.codes, points).clip(max=len(self.codes) - 1)
        kinds = np.where(self.codes[place] == points, place, len(self.codes))
        order = np.argsort(-sizes, kind="stable")  # longest first, so that those still running are a front part
        begin = (np.cumsum(sizes) - sizes)[order]
        state = np.repeat(self.first[None, :], len(texts), axis=0)
        running = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")
        one, carry = np.uint64(1), np.uint64(63)
        for step, count in enumerate(running):
            kind = kinds[begin[:count] + step]
            before = state[:count]
            moved = before << one
            moved[:, 1:] |= before[:, :-1] >> carry
            state[:count] = (moved & self.take[kind]) | (before & self.stay[kind])
        found = np.empty((len(texts), len(self.ends)), dtype=bool)
        found[order] = (state[:, (self.ends // np.uint64(64)).astype(int)] >> (self.ends % np.uint64(64))) & one == 1
        return found


def judge(urls: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Per row: its id, host, path, the rule that decides (null, if none fits) and the verdict."""
    ready_for_python(urls.sparkSession)
    ranked = sorted(rules, key=lambda r: (-len(r.text), r.text))

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton([p for r in ranked for p in r.patterns()])
        texts = np.array([r.text for r in ranked] + [None], dtype=object)
        verdicts = np.array([r.verdict for r in ranked] + [default], dtype=object)
        for batch in batches:
            parts = [split_url(u if isinstance(u, str) else None) for u in batch["url"]]
            whole = [h.replace(MARK, "�") + MARK + p.replace(MARK, "�") for h, p in parts]
            which = np.full(len(parts), len(ranked))
            for low, high in _spans([len(w) for w in whole]):
                fits = automaton.fits(whole[low:high]).reshape(high - low, -1, 2).any(axis=2)
                which[low:high] = np.where(fits.any(axis=1), fits.argmax(axis=1) if fits.shape[1] else 0, len(ranked))
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "host": [h for h, _ in parts],
                    "path": [p for _, p in parts],
                    "rule": texts[which],
                    "verdict": verdicts[which],
                }
            )

    kind = urls.schema[id_col].dataType.simpleString()
    rows = urls.select(F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"))
    found = rows.mapInPandas(match, "id string, host string, path string, rule string, verdict string")
    return found.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


def _spans(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``_AT_ONCE`` characters, or of one longer text."""
    low = total = 0
    for high, size in enumerate(sizes):
        if high > low and total + size > _AT_ONCE:
            yield low, high
            low, total = high, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)
