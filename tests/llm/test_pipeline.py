"""The pipeline's stages, each against a plain version on its own input."""

import re
from collections import defaultdict

import corpus_pipeline as P
from tests.llm.test_operators import library_ids, plain_components


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        before, docs = {r.doc_id: r for r in docs.collect()}, spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        kept[name] = (before, {r.doc_id for r in docs.collect()})
    before, after = kept["language_id"]
    assert len(after) >= 0.98 * len(before) and all(re.search(r"[^\W\d_]", before[i].text or "") for i in after)
    before, after = kept["exact_dedup"]
    groups = defaultdict(list)
    for r in before.values():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append((-len(r.text or ""), r.doc_id))
    assert after == {min(g)[1] for g in groups.values()}
    before, after = kept["near_dedup"]
    assert after == {c for _, c in plain_components({i: r.text for i, r in before.items()}, 5, 80).values()}
    before, after = kept["decontamination"]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(w[k : k + 10]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() for w in [split(r.text)] for k in range(max(1, len(w) - 9) if w else 0)}
    sizes = {len(w) for w in windows}
    clean = {i for i, r in before.items() for w in [split(r.text)] if not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))}
    assert after == clean
    import public_tokenizers

    pieces = P.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in pieces} == clean
    some = {r.doc_id: r.text for r in docs.limit(5).collect()}
    for i, t in some.items():
        assert sum(r.length for r in pieces if r.doc_id == i) == len(library_ids(public_tokenizers.path("word_bpe_49k.json"), t))


def test_run_on_odd_rows(spark, tmp_path):
    """The whole pipeline on null and repeated ids, null and blank texts, repeated rows and a long text, with further columns."""
    prose = "the quick brown fox jumps over the lazy dog and then it sleeps under an old tree by the river until noon "
    rows = [
        (1, prose * 3, "en"), (1, prose * 3, "en"), (2, prose * 3 + " ", "en"), (None, prose * 3 + "again and again", "en"), (3, None, "en"), (4, " \n", None), (5, "12 34", "en"),
        (6, "mir geht es heute gut und ich gehe mit dem hund in den wald " * 4, "de"), (7, "question one two three four five six seven eight nine ten answer " * 2, "en"), (None, None, None), (8, prose + "word " * 20_000, "en"),
    ]
    spark.createDataFrame([(*r, "s", 5, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, key string, piece int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "question one two three four five six seven eight nine ten"), (2, None), (None, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = P.run(spark, str(tmp_path)).collect()
    lengths = defaultdict(int)
    for r in got:
        lengths[r.doc_id] += r.length
    assert 7 not in lengths and 5 not in lengths and 3 not in lengths and 4 not in lengths  # contaminated, no letter, null, blank
    assert {6, 8} <= set(lengths) and len({1, 2} & set(lengths)) == 1 and lengths[8] > 20_000


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
