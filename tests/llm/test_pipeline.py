"""The pipeline stage by stage on planted rows."""

import random

import corpus_pipeline
from reefgrid.llm.common import ready


def test_stages_take_effect(spark, tmp_path):
    ready(spark)
    random.seed(4)

    def prose(n):
        return " ".join("".join(random.choices("abcdefghijklmnoprstuvwy", k=random.randint(2, 9))) for _ in range(n))

    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(random.choice([30, 60, 600]) if i > 3 else 60).split()
        if toxic:
            for k in range(0, len(words), 6):
                words[k] = random.choice(["vilescum", "idiotic", "moronic"])
        rows.append([i, " ".join(words), "en", f"s{i % 15}", 0])
        labels.append((i, 1, int(toxic)))
    line = "All rights reserved by the owner of this page."
    for i in range(1, 100, 2):
        rows[i][1] += "\n" + line
    rows += [[500, rows[1][1], "en", "s1", 0], [501, rows[3][1].replace(" ", "  ") + " end", "en", "s2", 0], [502, None, None, None, None], [503, line, "en", "s3", 0]]
    item = prose(15)
    rows.append([504, prose(20) + " " + item.upper() + "! " + prose(20), "en", "s4", 0])
    rows.append([505, prose(900), "en", "s5", 0])
    for name, data, schema in (
        ("documents", [tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", [(1, item)], "item_id long, text string"),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        docs.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        seen.append({r.doc_id: r.text for r in docs.collect()})
    toxicity, lines, near, clean = seen
    assert len([i for i in toxicity if i < 400 and i % 4 == 0]) <= 3
    assert len([i for i in toxicity if i < 400]) >= 295 and {500, 501, 502, 504, 505} <= set(toxicity)
    assert line in lines[1] and line not in lines[3] and 503 not in lines and 502 in lines
    # Document 1 keeps the line, so that its copy is no copy any more but still a near one.
    assert set(lines) - set(near) == {500, 501}
    assert set(near) - set(clean) == {504}
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(clean)


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(ready(spark), str(tmp_path)).count() == 0
