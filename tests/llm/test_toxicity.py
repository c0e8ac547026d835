"""Folding, matching, exceptions and held-out accuracy."""

from pyspark.sql import functions as F

from tallyloom.llm import toxicity


def test_folding():
    assert toxicity.words_of("1d10t IDI0T! ıdіоt id​iot ＩＤＩＯＴ") == ["idiot"] * 5
    assert toxicity.words_of("call 2020 at 12:30, été") == ["call", "2020", "at", "12", "30", "été"]


def test_matching_and_exceptions():
    dumped = toxicity.Lexicon({"idiot": 5.0, "wort*": 4.0}, ["idiot proof"]).dump()
    assert toxicity.hits("Idiot, worthless idiot worts", dumped)[0] == {"idiot": 2, "wort*": 2}
    assert toxicity.hits("an idiot-proof device, idiotic", dumped)[0] == {}
    assert toxicity.score("worthless", dumped) > 0.7 > toxicity.score("fine", dumped) == toxicity.score(None, dumped)
    long = "fine words " * 50_000
    assert 0 <= toxicity.score(long, dumped) < 0.7 and toxicity.score("x", toxicity.Lexicon({}, []).dump()) < 0.7


def rows_of():
    rows, labels = [], []
    for i in range(400):
        toxic = int(i % 8 == 0)
        rows.append((i, f"text number {i} goes on " + ("you idiot and moron" if toxic else "you idiot proof it" if i % 9 == 0 else "you there"), "x"))
        labels.append((i, toxic))
    return rows + [(None, None, "x"), (1000, "", "x"), (1, rows[1][1], "x")], labels + [(None, 1), (7, None)]


def test_learning(spark):
    rows, labels = rows_of()
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.learn(toxicity.training_rows(docs, marks))
    assert "moron" in lexicon.entries
    scored = toxicity.score_documents(docs, lexicon)
    assert scored.count() == len(rows)
    held = scored.where(toxicity.held_out()).join(marks.where("toxic is not null"), "doc_id")
    assert held.where(F.col("toxic") != F.col("predicted")).count() == 0
    kept = toxicity.keep_clean(docs, lexicon)
    assert kept.columns == docs.columns and kept.where("text is null").count() == 1
    assert toxicity.score_documents(docs.limit(0), lexicon).count() == 0


def test_without_toxic_rows(spark):
    docs = spark.createDataFrame([("a", 0)], "text string, toxic int")
    assert toxicity.learn(docs).entries == {} and toxicity.learn(docs.limit(0)).entries == {}


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = rows_of()
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    turned = marks.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(toxicity.training_rows(docs, marks)).dump() == toxicity.learn(toxicity.training_rows(docs, turned)).dump()


def hits_by_search(text, entries, exceptions):
    """Every entry looked for at every word, without an automaton."""
    words = toxicity.words_of(text)
    line, at, excused = f" {' '.join(words)} ", 0, set()
    places = []
    for w in words:
        places.append(at)
        at += len(w) + 1
    for phrase in exceptions:
        i = line.find(f" {phrase} ")
        while i >= 0:
            excused |= {p for p, w in zip(places, words, strict=True) if i <= p and p + len(w) <= i + len(phrase)}
            i = line.find(f" {phrase} ", i + 1)
    counts = {}
    for p, w in zip(places, words, strict=True):
        found = [e for e in entries if (w.startswith(e[:-1]) if e.endswith("*") else w == e)]
        if found and p not in excused:
            best = max(found, key=lambda e: (entries[e], e))
            counts[best] = counts.get(best, 0) + 1
    return counts


def test_matching_equals_a_search(spark):
    import random

    rng = random.Random(5)
    parts = ["bad", "badly", "ba", "worse", "wors", "so", "not", "b4d", "BAD", "ѕо", "é", "x1"]
    for _ in range(300):
        entries = {rng.choice(["bad", "ba*", "bad*", "wors*", "worse", "so", "not"]): float(rng.randint(1, 4)) for _ in range(4)}
        exceptions = [" ".join(rng.choices(["not", "bad", "so", "worse"], k=2)) for _ in range(2)]
        text = " ".join(rng.choices(parts, k=rng.randint(0, 25)))
        dumped = toxicity.Lexicon(entries, exceptions).dump()
        assert toxicity.hits(text, dumped)[0] == hits_by_search(text, entries, exceptions), (text, entries, exceptions)


def test_copies_do_not_make_a_lexicon(spark):
    """One toxic text that is there two hundred times, edited now and then: its other words are no entries."""
    import random

    rng = random.Random(1)
    vocabulary = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    copied = [f"rare{chr(97 + i)}{chr(98 + i)}" for i in range(20)]
    rows = []
    for i in range(600):
        words = rng.choices(vocabulary, k=30)
        if i % 6 == 0:
            words[rng.randrange(30)] = "scum"
        rows.append((i, " ".join(words), int(i % 6 == 0)))
    for i in range(600, 800):
        words = [*copied, "scum", *copied[::-1]]
        if i % 50 == 0:
            words[rng.randrange(40)] = rng.choice(vocabulary)
        rows.append((i, " ".join(words), 1))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    lexicon = toxicity.learn(toxicity.training_rows(docs, marks))
    assert [e for e in lexicon.entries if e.startswith("scum")]
    assert not [e for e in lexicon.entries if e.removesuffix("*") in {w[: len(e) - e.endswith("*")] for w in copied}]


def test_the_sample_is_bounded_whatever_the_texts(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'one text for a third', concat('text ', id)) AS text")
    marks = spark.range(3000).selectExpr("id AS doc_id", "int(id % 5 = 0) AS toxic")
    n = toxicity.training_rows(docs, marks, max_labelled=500).count()
    assert 350 < n < 650
