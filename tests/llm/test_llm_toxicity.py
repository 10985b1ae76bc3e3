import random
import time
import zlib

from bvengine.llm import toxicity as X
from llm.helpers import documents, prose


def test_grammar_reads_clauses():
    a = X.Grammar().automaton()

    def score(t):
        return sum(X.clauses(t.lower(), a))

    plain = score("what an idiot came by")
    assert plain > 0
    assert score("you are an idiot") > plain
    assert score("never an idiot came by") < plain and score("it is not an idiot") < plain
    assert score("he said that some idiot came") < score("he knew that some idiot came")
    assert score("i will kill you") > score("we kill some time") > 0
    assert score("you kill") == score("i kill you now") or score("you kill") > 0
    assert score("idiot. idiot") > score("idiot idiot") > plain
    assert score("idiotic skills of stupidity") == 0  # no whole word
    assert score("an unrelated sentence") == 0 and X.features(None, a) == X.features("", a) == (0.0, 0.0, 0.0)
    assert X.features("STUPID!", a)[2] > 0
    long = "word " * 100_000 + "idiot " + "word " * 1000
    assert X.features(long, a)[2] > 0


def one_after_the_other(words, found):
    """Best clause score with the transducers run separately: all their ways through the clause, multiplied at the end."""
    spelled = X.spelled(words, found)
    factors = [1.0] * len(spelled)
    choices = []
    for name, (start, table, ends) in X.TRANSDUCERS.items():
        ways = [(start, [])]
        for symbol, _ in spelled:
            ways = [(to, [*done, f]) for state, done in ways for to, f in table[state, X.SYMBOLS[symbol]]]
        ways = [done for state, done in ways if ends(state)]
        if len(ways) == 1:
            factors = [a * b for a, b in zip(factors, ways[0], strict=True)]
        else:
            assert name == "threat"
            choices = ways
    return max(sum(w * f * c for (_, w), f, c in zip(spelled, factors, way, strict=True)) for way in choices or [[1.0] * len(spelled)])


def test_composition_equals_the_transducers_one_after_the_other():
    r, a = random.Random(6), X.Grammar().automaton()
    vocabulary = [*X.INSULTS[:4], *X.THREATS[:3], *X.TARGETED_WORDS[:3], *X.NEGATIONS[:3], *X.REPORTS[:2], "table", "green", "walk"]
    assert len(X.composed()[0]) < 500
    for _ in range(600):
        text = " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 22)))
        words, found = [(m.start(), m[0]) for m in X.WORD.finditer(text)], X.symbols(text, a)
        assert abs(X.clause_score(words, found) - one_after_the_other(words, found)) < 1e-9


def test_threats_wait_for_their_target():
    a = X.Grammar().automaton()
    score = lambda t: sum(X.clauses(t, a))
    far, near = "kill a b c d you", "kill a b c you"
    assert score(near) == X.THREAT_WEIGHT and score(far) == X.THREAT_WEIGHT * X.LOOSE
    assert score("you a b c kill") == X.THREAT_WEIGHT and score("kill. you") == X.THREAT_WEIGHT * X.LOOSE


def test_long_texts_take_time_in_proportion():
    a = X.Grammar().automaton()
    for text, n in (("word " * 19 + "idiot ", 10_000), ("idiot. ", 40_000), ("a.b;", 100_000)):
        start = time.perf_counter()
        X.clauses(text * n + "idiot", a)
        assert time.perf_counter() - start < 8
    cut = X.clauses(("word " * 19 + "idiot ") * 10_000, a)
    assert len(cut) == 200_000 // X.CLAUSE


def corpus():
    """Toxic texts hold words of an invented language that clean ones lack, one of them only by its beginning."""
    rows, labels = [], []
    for i in range(600):
        words, toxic = prose(i, 60), i % 6 == 0
        if toxic:
            words[10], words[30], words[44] = "zorgu", "grompf" + words[3], "idiot" if i % 12 else "zorgu"
        rows.append((i, " ".join(words[:20]) + ". " + " ".join(words[20:])))
        if i % 7:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_learns_from_labels_and_scores_all_rows(spark):
    rows, labels = corpus()
    rows += [(10_000, None), (10_001, ""), (None, "zorgu you zorgu"), (10_002, rows[0][1])]
    docs = documents(spark, rows)
    marks = spark.createDataFrame([*labels, (99_999, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    grammar = X.learn(docs, marks)
    assert "zorgu" in grammar.words or any("zorgu".startswith(p.rstrip("*")) for p in grammar.words if p.endswith("*"))
    assert any(p.endswith("*") and "grompf".startswith(p[:-1]) for p in grammar.words)
    got = X.report(docs, marks).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in by if i is not None)
    held = [i for i in range(600) if by[i]["held_out"]]
    assert sum(by[i]["predicted"] == (i % 6 == 0) for i in held) >= 0.97 * len(held)
    assert by[10_000]["score"] == by[10_001]["score"] < 0.5 and by[10_002]["predicted"] == 1
    clean = X.clean(docs, marks)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i in by if not by[i]["predicted"]}


def test_patterns_are_as_specific_as_the_words_allow():
    found = {"scu*": (50, 5.0), "scum*": (50, 5.0), "scum": (50, 5.0), "low*": (60, 5.0), "lowe*": (60, 5.0), "lowei*": (59, 5.0), "loweis": (20, 5.0), "lowein": (15, 5.0)}
    assert X.chosen(found) == {"lowei*": 5.0, "scum": 5.0}
    assert X.chosen({}) == {}


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    held = {i for i, *_ in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    turned = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    a, b = (X.learn(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned))
    assert a == b


def test_without_labels(spark):
    docs = documents(spark, [(1, "you idiot, you are stupid scum"), (2, "fine")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["doc_id"]: r["predicted"] for r in X.report(docs, none).collect()} == {1: 1, 2: 0}
    assert X.report(docs.limit(0), none).count() == 0
