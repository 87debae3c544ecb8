"""The pipeline's stages against their operators' rules, on a small table with planted cases."""

import random

import corpus_pipeline
from folioflow.llm import decontaminate, line_dedup


def test_stages(spark, tmp_path):
    draw = random.Random(8)

    def words(n):
        return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(3, 8))) for _ in range(n))

    passage = words(40)
    rows, labels = [], []
    for i in range(400):
        text = "\n".join(words(12) for _ in range(6))
        toxic = i % 7 == 0
        if toxic:
            text = text.replace(" ", " moron ", 1) + " worthless moron pathetic"
        rows.append((i, text, "en", f"src{i % 5}", len(text)))
        labels.append((i, 1, int(toxic)))
    base = rows[1][1]
    rows += [(1000 + i, base + "\nSHARED line here", "en", "src1", 0) for i in range(15)]
    rows += [(2000, words(30) + " " + passage, "en", "src2", 0), (2001, None, "en", None, None), (2002, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
    assert all(seen[n].columns == columns for n in ("toxicity", "line_dedup", "simhash", "decontamination"))
    ids = {n: {r.doc_id for r in df.collect()} for n, df in seen.items()}
    clean = {r[0] for r in rows} - {i for i in range(400) if i % 7 == 0}
    assert ids["toxicity"] == clean == ids["line_dedup"]
    lines = {r.doc_id: r for r in seen["line_dedup"].collect()}
    assert lines[1].text == "" and lines[1005].text == "" and lines[2001].text is None and lines[3].n_chars == len(lines[3].text)
    # Emptied documents are copies of the empty one; of each group the smallest id stays.
    assert ids["simhash"] == clean - set(range(1000, 1015)) - {2001, 2002}
    assert ids["decontamination"] == ids["simhash"] - {2000} == ids["byte_bpe"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, seen["byte_bpe"].collect()))
    assert decontaminate.WINDOW == 13 and line_dedup.line_key(b" A ") == b"a"
