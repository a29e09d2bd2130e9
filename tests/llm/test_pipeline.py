import corpus_pipeline
from tests.llm.helpers import rows_of, words


def test_stages_do_their_work_and_keep_clean_documents(spark, tmp_path):
    import random

    rng = random.Random(3)
    item = " ".join(words(rng, 15, 5000))
    clean = [(i, " ".join(words(rng, 60, 5000))) for i in range(60)]
    rows = list(clean)
    rows += [(100 + i, " ".join(words(rng, 40, 5000)) + " vilething grimword vilething " + " ".join(words(rng, 10, 5000))) for i in range(40)]
    rows += [(200, clean[0][1]), (201, clean[1][1] + " more"), (202, " ".join(words(rng, 30, 5000)) + " " + item), (203, None), (204, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(100 <= i < 200)) for i, _ in rows[:100]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = [r[0] for r in rows_of(out, "doc_id")]
    assert got == [*range(60), 203]
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
    assert [r[0] for r in rows_of(now, "doc_id")] == got


def test_stages_by_brute_force_on_edges(spark, tmp_path):
    """Nulls, empty and repeated rows, ids on two texts, a very long text and clashing columns, stage by stage."""
    import hashlib
    import random
    from array import array

    from tests.llm.helpers import SPACE, ordered
    from tests.llm.test_byte_bpe import merge, regex_pieces
    from tests.llm.test_jaccard_join import brute
    from varloom.llm.decontaminate import words_of

    rng = random.Random(8)
    text = lambda n: " ".join(words(rng, n, 5000))
    base = [text(50) for _ in range(6)]
    item = text(14)
    rows = [(i, t) for i, t in enumerate(base)] + [(10, base[0]), (10, "other " + text(30)), (11, base[1].replace(" ", "\t ")), (None, base[2]), (None, text(20)), (12, base[3] + " tail"), (13, None), (14, ""), (15, "x"), (16, text(9_000)), (17, text(20) + " " + item), (2, base[2])]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, toxic int, h string, token long, ids string"
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 1, "h", 2, "z") for i, t in rows], ddl)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    run = lambda name, df: stages[name](spark, df, str(tmp_path))
    both = lambda df: rows_of(df, "doc_id", "text")
    assert both(run("toxicity", docs)) == ordered(rows)  # no label, no verdict
    norm = lambda t: SPACE.sub(" ", t or "")
    least = {}
    for i, t in rows:
        k = norm(t)
        least[k] = i if least.get(k) is None else min(least[k], i) if i is not None else least[k]
    assert both(run("exact_dedup", docs)) == ordered([(i, t) for i, t in rows if i == least[norm(t)]])
    gone = {i for i, _, c in brute(rows, 5, 80) if i is not None and c < i}
    assert both(run("jaccard_join", docs)) == ordered([(i, t) for i, t in rows if i not in gone])
    window = lambda t: {tuple(words_of(t)[k : k + 10]) for k in range(len(words_of(t)) - 9)}
    assert both(run("decontaminate", docs)) == ordered([(i, t) for i, t in rows if not window(t) & window(item)])
    few = [r for r in rows if len(r[1] or "") < 600]
    ranks, pieces = regex_pieces()
    want = []
    for i, t in few:
        ids = [x for p in pieces(t or "") for x in merge(ranks, p.encode())]
        want.append((i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = run("byte_bpe", spark.createDataFrame([(i, t, "en", "s", 1, 1, "h", 2, "z") for i, t in few], ddl))
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == ordered(want)
    for name in stages:
        empty = run(name, docs.limit(0))
        assert empty.count() == 0 and (name == "byte_bpe" or empty.columns == docs.columns)
