import random
import zlib

from tillroll.llm import toxic_grammar as T

SF = "/root/testdata/sf0.01"
WEIGHTS = {"idiot$": 5.0, "scu": 4.0}


def score(text):
    return sum(T.clause_scores(text, T.Lexicon(WEIGHTS))[0])


def test_clauses_not_words():
    assert score("What a lovely day, you and they said nothing.") == 0
    assert score("an idiot") == 5 * T.LONE_FACTOR
    assert score("you idiot") == 5 * T.AIMED_FACTOR
    assert score("you. idiot") == 5 * T.LONE_FACTOR
    assert score("idiot scum") == 9
    assert score("you are not an idiot") == 5 * T.AIMED_FACTOR * T.NEGATED_FACTOR
    assert score("not now, idiot") == 5 * T.LONE_FACTOR
    assert score('he said: "idiot"') == 5 * T.REPORTED_FACTOR * T.LONE_FACTOR
    assert score("she said so. And so. And so. idiot") == 5 * T.LONE_FACTOR
    assert score("I will kill you") == T.THREAT_WEIGHT
    assert score("kill the process") == 0
    assert score("SCUMBAG") == 4 * T.LONE_FACTOR


def test_contractions_negate():
    kill = T.THREAT_WEIGHT
    for text in ("I didn't kill you", "He can’t hurt you", "I won't hurt you", "I cannot hurt you", "you'll see, they couldn't beat him"):
        assert score(text) == kill * T.NEGATED_FACTOR, text
    assert score("don kill you") == kill
    assert score("the idiot't") == 5 * T.LONE_FACTOR


def test_composition_equals_running_in_turn():
    a, b = T.Transducer.of((False, 0), T._target_step), T.Transducer.of(0, T._negation_step)
    both = a.then(b)
    for symbols in (["negation", "target", "insult"], ["threat", "other", "target"], ["target", "boundary", "insult"]):
        s, x, y = both.start, a.start, b.start
        for symbol in symbols:
            s, out, f = both.arcs[s, symbol]
            x, mid, g = a.arcs[x, symbol]
            y, last, h = b.arcs[y, mid]
            assert (out, f) == (last, g * h)


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in T.op2_toxic_grammar(spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(rows[i].score, y) for i, y in labels.items() if rows[i].held_out]
    pairs = [(p > n) + (p == n) / 2 for p, y in held if y for n, z in held if not z]
    assert sum(pairs) / len(pairs) > 0.75
    assert sum((s >= 0.5) == bool(y) for s, y in held) / len(held) > 0.9


def tables(spark, path, docs, labels):
    given = [(i, t, "x", 9.0) for i, t in docs]
    spark.createDataFrame(given, "doc_id BIGINT, text STRING, label STRING, score DOUBLE").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id BIGINT, toxic INT").write.parquet(f"{path}/labels.parquet")
    return {(r.doc_id, round(r.score, 9), r.predicted) for r in T.op2_toxic_grammar(spark, str(path)).collect()}


def test_edges(spark, tmp_path):
    assert tables(spark, tmp_path / "a", [], []) == set()
    got = tables(spark, tmp_path / "b", [(1, None), (2, ""), (2, ""), (3, "I will kill you " * 20_000)], [(None, 1), (1, None)])
    assert {(i, p) for i, _, p in got} == {(1, 0), (2, 0), (3, 1)}


def test_learns_from_training_rows_only(spark, tmp_path):
    docs = [(i, ("zorgwort here" if i % 2 else "calm text here") + f" n{i}") for i in range(400)]
    # The held-out fifth is labelled the other way round.
    labels = [(i, (i % 2) if zlib.crc32(str(i).encode()) % 5 else 1 - i % 2) for i, _ in docs]
    assert {(i, p) for i, _, p in tables(spark, tmp_path, docs, labels)} == {(i, i % 2) for i, _ in docs}


VOCABULARY = {
    "insult": ["idiot", "scumbag"], "threat": ["kill"], "target": ["you", "them"], "negation": ["not", "isn't"],
    "report": ["said"], "other": ["tree", "blue", "idiotic"], "boundary": [".", ",", "\n"],
}


def plain_scores(tokens):
    """Every clause by its definition: no state, each word looks back over the tokens before it."""
    kind = {w: k for k, words in VOCABULARY.items() for w in words}
    kinds = [kind[t] for t in tokens]
    out, clauses, begin = [], 0, 0
    for end in [*(i for i, k in enumerate(kinds) if k == "boundary"), len(kinds)]:
        clause = kinds[begin:end]
        total = 0.0
        for i, k in enumerate(clause):
            before = clause[:i]
            weight = 0.0
            if k == "insult":
                weight = {"idiot": 5.0, "scumbag": 4.0}[tokens[begin + i]] * (T.AIMED_FACTOR if "target" in before else 1)
            if k == "target" and "threat" in before:
                at = i - 1 - before[::-1].index("threat")
                if i - at <= 4 and "target" not in clause[at:i]:
                    weight = T.THREAT_WEIGHT
            if "negation" in before[-3:]:
                weight *= T.NEGATED_FACTOR
            told = [j for j in range(begin + i) if kinds[j] == "report"]
            if told and kinds[told[-1] : begin + i].count("boundary") <= 2:
                weight *= T.REPORTED_FACTOR
            total += weight
        clauses += bool(clause)
        if total:
            out.append(total * (T.LONE_FACTOR if sum(k != "other" for k in clause) == 1 else 1))
        begin = end + 1
    return out, clauses


def test_grammar_equals_its_definition():
    pick = random.Random(7)
    for _ in range(4000):
        tokens = [pick.choice(VOCABULARY[pick.choice(list(VOCABULARY))]) for _ in range(pick.randrange(25))]
        scores, clauses = T.clause_scores(" ".join(tokens), T.Lexicon(WEIGHTS))
        wanted, n = plain_scores(tokens)
        assert clauses == n and [round(s, 9) for s in scores] == [round(s, 9) for s in wanted], tokens


def test_contradicting_labels_and_long_texts(spark, tmp_path):
    docs = [(i, ("zorgwort here " if i % 2 else "calm text here ") * (30_000 if i == 5 else 1) + f"n{i}") for i in range(400)]
    labels = [(i, i % 2) for i, _ in docs] + [(i, 0) for i, _ in docs if i % 2]  # toxic and clean: counts as toxic
    assert {(i, p) for i, _, p in tables(spark, tmp_path, docs, labels)} == {(i, i % 2) for i, _ in docs}
