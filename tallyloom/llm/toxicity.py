"""Toxicity scores from a weighted lexicon.

Texts are folded first: lower case, look-alike letters of other alphabets, full-width forms and accents that are
mere decoration to Latin, digits and signs that stand for letters (``1d10t``) to those letters.  Lexicon entries are
words and beginnings of words; an Aho-Corasick automaton finds all of them in one pass.  A hit counts where a word
begins (and, for whole words, ends), unless it lies within an exception phrase.  The score is a logistic function
of the weight of the distinct entries found and of the weighted hits per hundred words.

The lexicon is learned from labelled rows: entries whose smoothed log-odds are high, exception phrases that hold an
entry but occur in clean texts.  What speaks for an entry is counted in texts first, and then, for those that pass, in
texts that are unlike, so the words of one text that was copied many times are not taken for a lexicon.  Of more than ``max_labelled`` labelled documents about that many are used,
chosen by a hash of doc_id.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import sliced
from tallyloom.llm.quality import labelled_texts
from tallyloom.llm.workers import kept_by, task_of
from tallyloom.shared_folder import staged

#: Letters that look like a Latin one.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѕ": "s", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "о": "o", "р": "p", "ԛ": "q", "т": "t", "у": "y", "х": "x", "ѡ": "w", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ո": "n", "ս": "u", "օ": "o",
}
#: Digits and signs that stand for a letter inside a word.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

MAX_LABELLED = 40_000
#: Counts that a task holds before it sends them on.
HELD_COUNTS = 100_000
#: Lengths of word beginnings that may become entries.
PREFIXES = (4, 5, 6, 7, 8)
MIN_DOCS = 3
MIN_LOG_ODDS = 3.0
#: How many times likelier than chance an entry must be, beyond the number of entries tried (natural logarithm).
SURE = 3.0
THRESHOLD = 0.7

_FOLD = str.maketrans(LOOKALIKES)
_STAND = str.maketrans(STAND_INS)
_HIDDEN = re.compile("[\u00ad\u200b\u2060-\u2064\ufeff]")
_SIGNS = re.compile(r"[0-9@$!]+")


def _undone(text: str) -> str:
    """Stand-ins turned to letters in every run of letters, digits and signs that has a letter in it."""
    out, done = [], 0
    for found in _SIGNS.finditer(text):
        if found.start() < done:
            continue
        a, b = found.span()
        while a > done and (text[a - 1].isalnum() or text[a - 1] in "@$!"):
            a -= 1
        while b < len(text) and (text[b].isalnum() or text[b] in "@$!"):
            b += 1
        run = text[a:b].rstrip("!")  # a mark at the end is a mark
        out += (text[done:a], run.translate(_STAND) if any(c.isalpha() for c in run) else run)
        done = a + len(run)
        if done < found.end():
            out.append(text[done : found.end()])
            done = found.end()
    return "".join([*out, text[done:]]) if out else text


def fold(text: str) -> str:
    """The text with disguises undone; other texts only change to lower case."""
    text = text.lower() if text.isascii() else _HIDDEN.sub("", unicodedata.normalize("NFKC", text)).lower().translate(_FOLD)
    return _undone(text)


_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(fold(text))


class Lexicon:
    """Weights of words and of word beginnings (``entry*``), exception phrases, and the two slopes of the score."""

    def __init__(self, entries: dict[str, float], exceptions: list[str], bias: float = -2.0, slope: float = 1.0, density: float = 0.5) -> None:
        self.entries, self.exceptions = entries, exceptions
        self.bias, self.slope, self.density = bias, slope, density

    def dump(self) -> str:
        return json.dumps([self.entries, self.exceptions, self.bias, self.slope, self.density])


@functools.lru_cache(maxsize=4)
def _matcher(dumped: str) -> tuple[Lexicon, ahocorasick.Automaton | None]:
    lexicon = Lexicon(*json.loads(dumped))
    automaton = ahocorasick.Automaton()
    for entry, weight in lexicon.entries.items():
        open_end = entry.endswith("*")
        key = " " + (entry[:-1] if open_end else entry + " ")
        automaton.add_word(key, (key, weight, entry))
    for phrase in lexicon.exceptions:
        automaton.add_word(f" {phrase} ", (f" {phrase} ", None, phrase))
    if not len(automaton):
        return lexicon, None
    automaton.make_automaton()
    return lexicon, automaton


kept_by("toxicity", _matcher.cache_clear)


def hits(text: str, dumped: str) -> tuple[dict[str, int], float, int]:
    """Entries with their numbers of hits, their weighted sum, and the number of words."""
    lexicon, automaton = _matcher(dumped)
    words = words_of(text)
    if automaton is None or not words:
        return {}, 0.0, len(words)
    line = f" {' '.join(words)} "
    found, excused = [], []
    for end, (key, weight, entry) in automaton.iter(line):
        start = end - len(key) + 1
        if weight is None:
            excused.append((start, end))
        else:
            found.append((start, end, weight, entry))
    counts: dict[str, int] = {}
    best: dict[int, tuple[float, str]] = {}
    for start, end, weight, entry in found:
        if not any(a <= start and end <= b + 1 for a, b in excused):
            best[start] = max(best.get(start, (-1.0, "")), (weight, entry))  # one entry for each word
    for _, entry in best.values():
        counts[entry] = counts.get(entry, 0) + 1
    return counts, sum(w for w, _ in best.values()), len(words)


def score(text: str | None, dumped: str) -> float:
    """Between 0 and 1.  A null or empty text has the score of a text without hits."""
    lexicon, _ = _matcher(dumped)
    counts, weight, n = hits(text or "", dumped)
    x = lexicon.bias
    if counts:
        x += lexicon.slope * sum(lexicon.entries[e] for e in counts) + lexicon.density * math.log1p(100 * weight / n)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


@task_of("toxicity")
def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, docs): distinct words and word beginnings of each text, counted once a text and summed in the task."""

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())],
            names=["feature", "toxic", "docs"],
        )

    counts: dict[tuple[str, int], int] = {}
    for batch in sliced(batches):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = set(words_of(text or ""))
            for feature in words | {f"{w[:k]}*" for w in words for k in PREFIXES if k < len(w)}:
                key = feature, toxic
                counts[key] = counts.get(key, 0) + 1
            if len(counts) > HELD_COUNTS:
                yield sent()
                counts = {}
    yield sent()


def _entries_of(word: str, entries: dict[str, float]) -> list[str]:
    found = [word] if word in entries else []
    return found + [e for e in (f"{word[:k]}*" for k in PREFIXES if k < len(word)) if e in entries]


def _neighbourhoods(rows: DataFrame, entries: dict[str, float]) -> DataFrame:
    """(feature, t, c): in how many unlike toxic and clean texts an entry stands.

    A text has one mark for each entry: the smallest hash of the words on both sides of it, and the smallest hash of any
    two words of the text.  Marks are counted once, so copies of a text count as one, and so do most of its edited copies.
    """

    @task_of("toxicity")
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found: set[tuple[str, int, int, int]] = set()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text or "")
                marks: dict[str, int] = {}
                for i, w in enumerate(words):
                    for e in _entries_of(w, entries):
                        sides = " ".join([*words[max(0, i - 1) : i], "", *words[i + 1 : i + 2]])
                        marks[e] = min(marks.get(e, 1 << 32), zlib.crc32(sides.encode()))
                if marks:
                    least = min(zlib.crc32(f"{a} {b}".encode()) for a, b in itertools.pairwise(["", *words]))
                    found |= {(e, toxic, mark, least) for e, mark in marks.items()}
            columns = list(zip(*found, strict=True)) if found else [()] * 4
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["feature", "toxic", "mark", "least"])

    unlike = rows.mapInArrow(run, "feature string, toxic int, mark long, least long").distinct()
    return unlike.groupBy("feature").agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c"))


def learn(labelled: DataFrame) -> Lexicon:
    """A lexicon from rows (text, toxic); rows with a null text or label are left out.

    Counts are made on the cluster.  The entries that pass come to the driver: each stands in ``MIN_DOCS`` toxic texts
    at least and passes a bar that rises with what was tried, so their number is bounded by that of the labelled texts.
    Without toxic rows the lexicon is empty.
    """
    rows = staged(labelled.select(F.col("text"), F.col("toxic").cast("int").alias("toxic")).where("text is not null and toxic is not null"), "labelled")
    totals = rows.groupBy().agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    toxic, clean = int(totals.t or 0), int(totals.n - (totals.t or 0))
    if not toxic:
        return Lexicon({}, [])
    counted = staged(
        rows.mapInArrow(_features, "feature string, toxic int, docs long")
        .groupBy("feature")
        .agg(F.sum(F.when(F.col("toxic") == 1, F.col("docs")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("docs"))).alias("c")),
        "features",
    )
    rate = toxic / (toxic + clean)
    n, t, c = F.col("t") + F.col("c"), F.col("t"), F.col("c")
    odds = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    gain = t * F.log(t / (n * rate)) + F.when(c > 0, c * F.log(c / (n * (1 - rate)))).otherwise(0.0)
    tried = counted.where(t + c >= MIN_DOCS)
    bar = math.log(max(1, tried.count())) + SURE if clean else 0.0

    def sure(df: DataFrame) -> dict[str, tuple[float, int, int]]:
        passed = df.withColumns({"odds": odds, "gain": gain}).where((t >= MIN_DOCS) & (F.col("odds") >= MIN_LOG_ODDS) & (F.col("gain") >= bar))
        return {r.feature: (round(float(r.odds), 6), r.t, r.c) for r in passed.collect()}

    def stands_alone(t: int, c: int) -> bool:
        if t < MIN_DOCS or math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)) < MIN_LOG_ODDS:
            return False
        return t * math.log(t / ((t + c) * rate)) + (c * math.log(c / ((t + c) * (1 - rate))) if c else 0.0) >= bar

    chosen = sure(_neighbourhoods(rows, dict.fromkeys(sure(tried), 0.0)))
    entries: dict[str, float] = {}
    for e, (weight, t_e, c_e) in sorted(chosen.items(), key=lambda x: (-x[1][0], x[0].endswith("*"), len(x[0]), x[0])):
        start = e.removesuffix("*")
        # A longer entry that weighs no more than a chosen beginning of it never counts; a beginning has to pass
        # without what a heavier entry that it covers finds already.
        if any(f"{start[:k]}*" in entries for k in PREFIXES if k < len(start)):
            continue
        covered = [chosen[x][1:] for x in entries if e.endswith("*") and x.startswith(start)]
        if all(stands_alone(t_e - t_x, c_e - c_x) for t_x, c_x in covered):
            entries[e] = weight
    exceptions = _exceptions(rows, entries)
    # Clean texts lie at the bias; one sure entry (log-odds of four or more) carries a text over the threshold.
    return Lexicon(entries, exceptions, bias=math.log((toxic + 1) / (clean + toxic + 1)) - 1.5, slope=1.0, density=0.5)


def _exceptions(rows: DataFrame, entries: dict[str, float]) -> list[str]:
    """Word pairs around a hit that occur in clean texts only, at least ``MIN_DOCS`` times."""

    @task_of("toxicity")
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            phrases: list[str] = []
            labels: list[int] = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text or "")
                seen = set()
                for i, w in enumerate(words):
                    if _entries_of(w, entries):
                        seen |= {" ".join(words[max(0, i - 1) : i + 1]), " ".join(words[i : i + 2])} - {w}
                phrases += seen
                labels += [toxic] * len(seen)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.string()), pa.array(labels, pa.int32())], names=["phrase", "toxic"])

    found = rows.mapInArrow(run, "phrase string, toxic int").groupBy("phrase").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    return sorted(r.phrase for r in found.where((F.col("t") == 0) & (F.col("n") >= MIN_DOCS)).collect())


def score_documents(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score, predicted of every row; the score depends on the text alone."""
    dumped = lexicon.dump()

    @task_of("toxicity")
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            scores = [score(t, dumped) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())],
                names=["doc_id", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(text, toxic) of the labelled documents that are not held out, one row a doc_id; about ``max_labelled`` at most.

    Labels are bounded before they meet the documents, so the documents stay where they are.
    """
    rows = labelled_texts(docs, labels.where(~held_out()), "toxic", max_labelled)
    return rows.select("text", F.col("label").alias("toxic"))


def keep_clean(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents below the threshold, with their columns; null texts are kept."""
    dumped = lexicon.dump()
    names = docs.columns
    at = names.index("text")

    @task_of("toxicity")
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield batch.filter(pa.array([score(t, dumped) < THRESHOLD for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
