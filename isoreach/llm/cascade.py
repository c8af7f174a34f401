"""Quality rules as a short-circuit cascade.

Each rule says from a text's measures whether it is rejected.  On a bounded
sample, the texts of the smallest id hashes, every rule is run on its own: its
cost is what its measures cost, its selectivity the share it rejects.  The rules then run in the order of rejection
per cost, each only on the documents that all earlier ones have kept, and a
measure is computed when the first rule that needs it comes up.  The verdict is
the same in any order; only the work differs.
"""

from __future__ import annotations

import math
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.llm.runtime import ship, smallest_hashes
from isoreach.llm.textcore import batches, raw

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
#: Texts that the order of the rules is estimated on, and how often each rule is run there; the verdict doesn't depend on them.
SAMPLE_ROWS, REPEATS = 400, 3
MIN_WORDS = 50


class Text:
    """A text and its measures, each computed once and only when asked for."""

    def __init__(self, text: bytes | None) -> None:
        self.raw = text or b""

    def __getattr__(self, name: str):
        make = MEASURES.get(name)
        if make is None:
            raise AttributeError(name)
        value = make(self)
        self.__dict__[name] = value
        return value


def _chars(text: bytes) -> int:
    """Code points: all bytes but UTF-8's continuation bytes."""
    return len(text.decode("utf-8", "replace"))


def _ids(x: Text) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in x.words), dtype=np.int64, count=len(x.words))


def repeated_places(ids: np.ndarray, width: int = 3) -> int:
    """Places inside a window of `width` ids that occurs twice or more, every occurrence counted."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    code = ids[:n]
    for k in range(1, width):  # codes stay below n * n, so they are exact at any length
        _, code = np.unique(code, return_inverse=True)
        code = code * (int(ids.max()) + 1) + ids[k : n + k]
    _, at, count = np.unique(code, return_inverse=True, return_counts=True)
    hit = np.zeros(len(ids), dtype=bool)
    twice = np.flatnonzero(count[at] > 1)
    for k in range(width):
        hit[twice + k] = True
    return int(hit.sum())


def _dup_lines(x: Text) -> int:
    lines = [line for line in x.raw.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def _without(text: bytes, characters: bytes) -> int:
    """How many of the characters a text has."""
    return len(text) - len(text.translate(None, characters))


BULLETS = (b"-", b"*", "\u2022".encode())
MEASURES: dict[str, Callable[[Text], object]] = {
    "words": lambda x: x.raw.split(),
    "n_words": lambda x: len(x.words),
    "ids": _ids,
    "word_chars": lambda x: _chars(x.raw) - sum(x.raw.count(c) for c in SPACES),
    "n_symbols": lambda x: sum(x.raw.count(c) for c in SYMBOLS),
    "n_dup_lines": _dup_lines,
    "n_lines": lambda x: sum(1 for line in x.raw.split(b"\n") if line.strip(SPACES)),
    "n_repeat_words": lambda x: repeated_places(x.ids),
    "n_shouts": lambda x: x.raw.count(b"!!"),
    "n_distinct": lambda x: len(set(x.words)),
    "top_count": lambda x: max(Counter(x.words).values(), default=0),
    "n_digits": lambda x: _without(x.raw, b"0123456789"),
    "n_capitals": lambda x: _without(x.raw, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "n_ellipses": lambda x: sum(1 for line in x.raw.split(b"\n") if line.rstrip(SPACES).endswith(b"...")),
    "n_bullets": lambda x: sum(1 for line in x.raw.split(b"\n") if line.lstrip(SPACES).startswith(BULLETS)),
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


#: The base rules, then rules of the method's own; the thresholds leave ordinary prose far from rejection.
RULES = (
    Rule("few_words", lambda x: x.n_words < MIN_WORDS),
    Rule("repeated_windows", lambda x: 100 * x.n_repeat_words > 50 * x.n_words),
    Rule("symbols", lambda x: 10 * x.n_symbols > 2 * x.n_words),
    Rule("shouting", lambda x: 10 * x.n_shouts > 2 * x.n_words),
    Rule("duplicate_lines", lambda x: x.n_lines >= 4 and 100 * x.n_dup_lines > 60 * x.n_lines),
    Rule("word_length", lambda x: not 2 * x.n_words <= x.word_chars <= 15 * x.n_words),
    Rule("few_distinct", lambda x: 50 * x.n_distinct < x.n_words),
    Rule("one_word", lambda x: 100 * x.top_count > 40 * x.n_words),
    Rule("digits", lambda x: 10 * x.n_digits > 9 * x.word_chars),
    Rule("capitals", lambda x: 10 * x.n_capitals > 7 * x.word_chars),
    Rule("ellipses", lambda x: x.n_lines >= 4 and 100 * x.n_ellipses > 60 * x.n_lines),
    Rule("bullets", lambda x: x.n_lines >= 4 and 100 * x.n_bullets > 90 * x.n_lines),
)
BASE = {"few_words", "repeated_windows"}


def estimate(texts: list[bytes | None], rules: tuple[Rule, ...] = RULES) -> list[tuple[str, float, float]]:
    """(rule, seconds a text, share rejected) of each rule run alone on a sample."""
    found = []
    for rule in rules:
        spent, rejected = math.inf, 0
        for _ in range(REPEATS):
            began = time.process_time()
            rejected = sum(rule.rejects(Text(t)) for t in texts)
            spent = min(spent, time.process_time() - began)
        found.append((rule.name, max(spent, 1e-9) / max(1, len(texts)), rejected / max(1, len(texts))))
    return found


def ordered(estimates: list[tuple[str, float, float]]) -> list[str]:
    """Rules by rejection per cost, the most first; ties by name."""
    return [name for name, _, _ in sorted(estimates, key=lambda e: (-e[2] / e[1], e[0]))]


def cascade(x: Text, order: list[Rule]) -> str | None:
    """The first rule that rejects; the rules after it aren't run."""
    return next((rule.name for rule in order if rule.rejects(x)), None)


def _estimates(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        found = estimate(raw(b.column(1)))
        cols = [[e[0] for e in found], [e[1] for e in found], [round(e[2] * b.num_rows) for e in found], [b.num_rows] * len(found)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.float64(), pa.int64(), pa.int64()), strict=True)], names=["name", "cost", "rejected", "n"])


def _judge(order: list[str], counts: bool):
    by_name = {rule.name: rule for rule in RULES}
    rules = [by_name[name] for name in order]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            rows = []
            for text in raw(b.column(1)):
                x = Text(text)
                by = cascade(x, rules)
                if counts:
                    failed = x.n_words < MIN_WORDS or 100 * x.n_repeat_words > 50 * x.n_words
                    rows.append((x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, failed, by is None, by))
                else:
                    rows.append((by is None, by))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 5 + [pa.bool_()] if counts else []
            kinds += [pa.bool_(), pa.string()]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"] if counts else []
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["doc_id", *names, "kept", "rejected_by"])

    return run


def judge(spark: SparkSession, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """Judge every document by the cascade.

    Returns doc_id, kept, rejected_by (the rule that ended the cascade; which of
    several it is depends on the estimated order), and with counts also n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed, which
    cover the whole text whatever the cascade skipped.  Words are runs without
    white space.  A null text counts as empty and is rejected; rows keep their
    order, repeated ones are judged alike; an empty table gives an empty result.
    """
    ship(spark)
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = smallest_hashes(docs, "doc_id", SAMPLE_ROWS).mapInArrow(_estimates, "name string, cost double, rejected long, n long")  # the texts stay on an executor
    seen: dict[str, list[float]] = {r.name: [0.0, 0, 0] for r in RULES}
    for r in sample.collect():
        seen[r.name] = [x + y for x, y in zip(seen[r.name], (r.cost * r.n, r.rejected, r.n), strict=True)]
    order = ordered([(k, max(c, 1e-9) / max(1, n), rejected / max(1, n)) for k, (c, rejected, n) in seen.items()])
    middle = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, " if counts else ""
    return docs.mapInArrow(_judge(order, counts), f"doc_id long, {middle}kept boolean, rejected_by string")


def base_sql() -> str:
    """DuckDB SQL for the counts and base_failed over documents; the verdict kept is the rules', written out."""
    return f"""
    with d as (
      select row_number() over () as row_id, doc_id, coalesce(text, '') as t,
        regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0d]+') as words from documents),
    counted as (
      select row_id, doc_id, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
        t, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        ((length(t) - length(replace(t, '!!', ''))) // 2)::bigint as n_shouts,
        list_filter(string_split(t, chr(10)), lambda x: length(regexp_replace(x, '[ \\x09-\\x0d]+', '', 'g')) > 0) as lines from d),
    grams as (
      select row_id, pos, words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] as g
      from (select row_id, words, unnest(range(1, len(words) - 1)) as pos from d)),
    twice as (select row_id, pos from (select row_id, pos, count(*) over (partition by row_id, g) as c from grams) where c > 1),
    places as (select row_id, count(distinct pos + k) as n from twice, (select unnest([0, 1, 2]) as k) group by row_id),
    tops as (select row_id, max(c) as top_count, count(*) as n_distinct from (select row_id, w, count(*) as c from (select row_id, unnest(words) as w from d) group by row_id, w) group by row_id),
    m as (
      select c.*, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines) as n_lines, coalesce(p.n, 0)::bigint as n_repeat_words,
        coalesce(o.top_count, 0) as top_count, coalesce(o.n_distinct, 0) as n_distinct,
        length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) as n_digits, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_capitals,
        len(list_filter(lines, lambda x: regexp_matches(x, '[.][.][.][ \x09-\x0d]*$'))) as n_ellipses,
        len(list_filter(lines, lambda x: regexp_matches(x, '^[ \x09-\x0d]*[-*\u2022]'))) as n_bullets
      from counted c left join places p using (row_id) left join tops o using (row_id))
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      (n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words) as base_failed,
      not (n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words or 10 * n_symbols > 2 * n_words or 10 * n_shouts > 2 * n_words
        or (n_lines >= 4 and 100 * n_dup_lines > 60 * n_lines) or not (2 * n_words <= word_chars and word_chars <= 15 * n_words)
        or 50 * n_distinct < n_words or 100 * top_count > 40 * n_words or 10 * n_digits > 9 * word_chars or 10 * n_capitals > 7 * word_chars
        or (n_lines >= 4 and 100 * n_ellipses > 60 * n_lines) or (n_lines >= 4 and 100 * n_bullets > 90 * n_lines)) as kept
    from m"""
