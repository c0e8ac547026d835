"""Periodic runs of words, found with a dictionary of basic factors.

The words of a text are numbered; factors of 1, 2, 4, … words get names, a name for each pair of names of half the
length, as long as some factor occurs twice in a text.  Where a factor of 2^k words occurs again within 2^(k+1) words,
the distance to its next occurrence is a proposed period; starts that follow each other with the same distance form
one progression and are one proposal.  A proposal is extended to both sides by comparing factors of falling lengths,
kept if it is long enough, and counted once.

Nothing is missed: in a run of period q and three periods or more, a factor of 2^k words with q <= 2^k < 2q occurs
again after exactly q words, for its first q words are no power of a shorter text.  The same holds of what is found:
had a long enough stretch a shorter period, the next occurrence would have been nearer.

Texts are worked on in groups, each word marked with its text, so no factor reaches over an end.  Memory is four bytes
for each word of a group and each length at which a factor still repeats; a group has ``CHUNK_BYTES`` or is one text.
Null and empty texts have no words and no runs.  Rows without an identifier are read as they are.  Rows are independent
of each other, so repeated rows and an empty table need nothing special; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 24
MIN_PERIODS = 3
CHUNK_BYTES = 2 << 20

_WORD = re.compile(r"[^ \t-\r]+")

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def factor_names(words: np.ndarray) -> list[np.ndarray]:
    """For each power of two, the name of the factor that starts at each word: equal names, equal factors.

    A factor that occurs once is named by its place, below 0.  There is one place more than words, for the end.
    """
    n = len(words)
    single = -1 - np.arange(n + 1, dtype=np.int32)
    levels: list[np.ndarray] = []
    at, keys = np.arange(n), words
    while len(at):
        _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = counts[names] > 1
        level = single.copy()
        level[at[twice]] = names[twice]
        levels.append(level)
        half = 1 << (len(levels) - 1)
        at = at[twice]
        at = at[at + half <= n]
        at = at[(level[at] >= 0) & (level[at + half] >= 0)]
        keys = level[at].astype(np.int64) * (n + 1) + level[at + half]
    return levels


def proposals(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): the first place of each progression of next occurrences."""
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, level in enumerate(levels):
        at = np.flatnonzero(level >= 0)
        order = at[np.argsort(level[at], kind="stable")]
        gap = np.diff(order)
        near = (level[order[:-1]] == level[order[1:]]) & (gap <= 2 << k)
        next_at = np.zeros(len(level) + 1, np.int64)
        next_at[order[:-1][near] + 1] = gap[near]
        heads = np.flatnonzero((next_at[1:] > 0) & (next_at[1:] != next_at[:-1]))
        places.append(heads)
        periods.append(next_at[heads + 1])
    return np.concatenate(places), np.concatenate(periods)


def extended(levels: list[np.ndarray], places: np.ndarray, periods: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the stretches around ``places`` in which words a period apart are equal."""
    n = len(levels[0]) - 1 if levels else 0
    right, left = places.copy(), places.copy()
    for k in reversed(range(len(levels))):
        level, size = levels[k], 1 << k
        same = level[np.minimum(right, n)] == level[np.minimum(right + periods, n)]
        right += np.where(same & (right + periods + size <= n), size, 0)
        back = left - size
        same = (back >= 0) & (level[np.maximum(back, 0)] == level[np.maximum(back + periods, 0)])
        left -= np.where(same, size, 0)
    return left, right + periods


def runs_of(words: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> Runs:
    """(start, length, period) of all runs, by start, then period.  ``min_periods`` is three or more."""
    levels = factor_names(words)
    places, periods = proposals(levels)
    start, end = extended(levels, places, periods)
    kept = end - start >= np.maximum(min_length, min_periods * periods)
    found = np.unique(np.stack([start[kept], periods[kept], end[kept] - start[kept]], axis=1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


Planted = Callable[[object, int], np.ndarray | None]


def planted_period(doc_id: object, n: int) -> np.ndarray | None:
    """Which original word stands at each place, for texts that a period is planted in; None for all others."""
    if doc_id is None or not n:
        return None
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def _grouped(texts: list[str]) -> Iterator[tuple[int, int]]:
    a, size = 0, 0
    for b, text in enumerate(texts):
        if b > a and size + len(text) > CHUNK_BYTES:
            yield a, b
            a, size = b, 0
        size += len(text)
    if a < len(texts):
        yield a, len(texts)


def _best(start: list[int], length: list[int], period: list[int]) -> int:
    """The run with most periods, exactly; then the first, then the shortest period."""
    best = 0
    for i in range(1, len(start)):
        if length[i] * period[best] > length[best] * period[i]:  # runs come by start and period
            best = i
    return best


def _reports(doc_ids: list, texts: list[str], planted: Planted | None) -> list[tuple]:
    numbers: dict[str, int] = {}
    words, ids = [], []
    for doc_id, text in zip(doc_ids, texts, strict=True):
        own = _WORD.findall(text)
        order = planted(doc_id, len(own)) if planted else None
        if order is not None:
            own = [own[i] for i in order.tolist()]
        words.append(own)
        ids.append(np.array([numbers.setdefault(w, len(numbers)) for w in own], np.int64))
    bounds = np.cumsum([0, *map(len, words)])
    marked = np.concatenate(ids) + np.repeat(np.arange(len(ids), dtype=np.int64) * (len(numbers) + 1), np.diff(bounds))
    start, length, period = runs_of(marked)
    depth = np.zeros(bounds[-1] + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    kept = np.cumsum(depth)[:-1] == 0
    cuts = np.searchsorted(start, bounds)
    rows = []
    for d, own in enumerate(words):
        s, e = cuts[d], cuts[d + 1]
        best, listed = (None,) * 4, ""
        if e > s:
            at, n, q = (start[s:e] - bounds[d]).tolist(), length[s:e].tolist(), period[s:e].tolist()
            b = _best(at, n, q)
            best = at[b], n[b], q[b], 1000 * n[b] // q[b]
            listed = "".join(f"{x},{y},{z}\n" for x, y, z in zip(at, n, q, strict=True))
            own = [w for w, k in zip(own, kept[bounds[d] : bounds[d + 1]].tolist(), strict=True) if k]
        rows.append((int(e - s), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(own).encode()).hexdigest()))
    return rows


COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def periodic_runs(docs: DataFrame, planted: Planted | None = None) -> DataFrame:
    """doc_id and what was found in each text.  ``planted`` may give another order of a text's words first."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            rows = [r for a, b in _grouped(texts) for r in _reports(doc_ids[a:b], texts[a:b], planted)]
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["doc_id", *names]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text")).mapInArrow(run, f"doc_id {kind}, {COLUMNS}")


def _sql(levels: int = 21) -> str:
    """Names level by level; a progression of next occurrences no further apart than a factor is long is a whole run."""
    steps = []
    for k in range(levels):
        size = 1 << k
        if k:
            steps.append(f"""
pair{k} AS (
  SELECT row_id, i, name, other FROM (
    SELECT row_id, i, name, lead(i, {size // 2}) OVER w AS there, lead(name, {size // 2}) OVER w AS other
    FROM level{k - 1} WINDOW w AS (PARTITION BY row_id ORDER BY i)) WHERE there = i + {size // 2}),
level{k} AS MATERIALIZED (SELECT row_id, i, min(i) OVER (PARTITION BY row_id, name, other) AS name FROM pair{k})""")
        steps.append(f"""
gap{k} AS (SELECT row_id, i, lead(i) OVER (PARTITION BY row_id, name ORDER BY i) - i AS q FROM level{k}),
run{k} AS (
  SELECT row_id, min(i) AS a, q, count(*) - 1 + {size} + q AS n
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row_id, q ORDER BY i) AS island
        FROM gap{k} WHERE q <= {size} AND q > {size // 2})
  GROUP BY row_id, q, island)""")
    every = "\n  UNION ALL ".join(f"SELECT * FROM run{k}" for k in range(levels))
    return rf"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
sized AS (
  SELECT *, len(words) AS n_words, xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
    lambda c, b: list_reduce(range(8), lambda x, s: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END, xor(c, b)),
    4294967295::BIGINT), 4294967295::BIGINT) AS h FROM texts),
planted AS (SELECT *, h // 10 % n_words AS a, 1 + (n_words - h // 10 % n_words) // (3 + h // 10 % 8) AS p FROM sized),
word AS (
  SELECT row_id, i, words[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS w
  FROM (SELECT *, unnest(range(n_words)) AS i FROM planted)),
level0 AS MATERIALIZED (SELECT row_id, i, min(i) OVER (PARTITION BY row_id, w) AS name FROM word),{",".join(steps)},
runs AS (SELECT * FROM ({every}) WHERE n >= greatest({MIN_LENGTH}, {MIN_PERIODS} * q)),
found AS (
  SELECT row_id, count(*) AS n_runs, sha256(string_agg(a || ',' || n || ',' || q || chr(10), '' ORDER BY a, q)) AS runs_sha256 FROM runs GROUP BY row_id),
best AS (
  SELECT * FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs o WHERE o.row_id = r.row_id
    AND (o.n * r.q > r.n * o.q OR o.n * r.q = r.n * o.q AND (o.a < r.a OR o.a = r.a AND o.q < r.q)))),
gone AS (SELECT DISTINCT row_id, unnest(range(a + q, a + n)) AS i FROM runs),
kept AS (
  SELECT row_id, sha256(string_agg(w, ' ' ORDER BY i)) AS collapsed_sha256
  FROM word ANTI JOIN gone USING (row_id, i) GROUP BY row_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, a AS start, n AS length, q AS period, 1000 * n // q AS exponent_milli,
       coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM texts LEFT JOIN found USING (row_id) LEFT JOIN best USING (row_id) LEFT JOIN kept USING (row_id)
"""


SQL = _sql()
