import re

import corpus_pipeline
from tests.llm.test_packing import check
from tests.llm.test_shingle_join import brute as similar
from tests.llm.test_string_tiling import brute as tiled
from tillroll.llm import surrogates, toxic_grammar
from tillroll.llm.common import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables(spark, path):
    """Rows for every stage beside plain ones, and odd ones."""
    clean = [f"calm words number {i} " + " ".join(f"c{i}x{k}" for k in range(60)) for i in range(80)]
    toxic = [f"you zorgwort and scumwort {i} " + " ".join(f"t{i}x{k}" for k in range(20)) for i in range(60)]
    item = " ".join(f"bench{k}" for k in range(20))
    near = clean[3].replace("c3x40 ", "")
    texts = clean + toxic + [near, clean[5], clean[5], None, "", f"before {item} after", f"Ask Mr. Smith at a.b@c.example.com {' '.join(f'p{k}' for k in range(30))}"]
    docs = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i >= 80)) for i in range(140)]
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item), (1, "")], "item_id BIGINT, text STRING").write.parquet(f"{path}/benchmark.parquet")
    return texts, item


def test_every_stage_against_a_plain_version(spark, tmp_path):
    texts, item = tables(spark, tmp_path)
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, str(tmp_path)), "test-stage")
        assert docs.columns == COLUMNS
        seen[name] = {r.doc_id: r.text for r in docs.collect()}

    assert seen["toxicity"] == {i: t for i, t in enumerate(texts) if not 80 <= i < 140}
    left = list(seen["toxicity"].items())
    groups = {left[i][0]: left[c][0] for i, _, c in similar([t for _, t in left])}
    assert set(seen["near_duplicates"]) == {i for i, c in groups.items() if i == c}
    assert not {140, 141, 142} & set(seen["near_duplicates"])
    bad = {i for i, t in seen["near_duplicates"].items() if tiled(t, item)[0] >= 0.5}
    assert bad == {145} and set(seen["decontamination"]) == set(seen["near_duplicates"]) - bad
    changed = {i for i, t in seen["personal_data"].items() if t != seen["decontamination"][i]}
    assert changed == {146} and not re.search(r"Smith|a\.b@c", seen["personal_data"][146])

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by_id = [seen["personal_data"].get(i) for i in range(len(texts))]
    parts, ids = check(pieces, by_id)
    assert set(parts) == set(seen["personal_data"])
    assert all(sum(n for _, n in p) == len(ids[i]) for i, p in parts.items())


def test_empty_tables(spark, tmp_path):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_call_the_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert surrogates.KEY and toxic_grammar.MAX_TRAINING_DOCS == 20_000


def test_a_phone_followed_by_other_numbers_does_not_end_the_run(spark):
    """More drawn digits than a long holds were an error of the stage of personal data (F1)."""
    texts = ["Call +1 (017) 555-7713 4802 1234 5678 now", "Call +1 (017) 555-7713 now", None]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, n_chars BIGINT")
    out = {r.doc_id: r for r in corpus_pipeline.replace_personal_data(spark, docs, "").collect()}
    assert len(out) == 3 and out[2].text is None and all(out[i].text != texts[i] and out[i].n_chars == len(texts[i]) for i in (0, 1))
