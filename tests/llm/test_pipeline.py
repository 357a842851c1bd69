"""The pipeline's stages on documents with planted cases, and the corpus SQL."""

import random

import pytest

import corpus_pipeline
from reelspan.llm import queries

from .test_corpus import DOCS, words


def planted(spark, path):
    r, rows, labels = random.Random(9), {}, {}
    for i in range(200):
        w = words(80, 1000 + i)
        labels[i] = int(i % 4 == 0)
        if labels[i]:
            w[r.randrange(80)] = r.choice(["idiot", "scum"])
        rows[i] = " ".join(w)
    rows[300], rows[301] = rows[1], rows[3].replace(rows[3].split()[40], "other", 1)
    passage = " ".join(words(60, 77))
    for i in (302, 303):
        rows[i] = " ".join(words(30, i)) + " " + passage + " " + " ".join(words(30, 2 * i))
    rows[304], rows[305] = None, ""
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows.items()], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels.items()], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return rows, labels, passage


def test_stages(spark, tmp_path):
    rows, labels, passage = planted(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        docs.write.parquet(f"{tmp_path}/out-{len(kept)}")
        docs = spark.read.parquet(f"{tmp_path}/out-{len(kept)}")
        kept.append({x["doc_id"]: x["text"] for x in docs.collect()})
    toxic = {i for i, y in labels.items() if y}
    assert set(kept[0]) == set(rows) - toxic
    assert set(kept[0]) - set(kept[1]) == {1, 304} and set(kept[1]) - set(kept[2]) == {301}
    assert set(kept[3]) == set(kept[2]) and passage in kept[3][302] and passage not in kept[3][303]
    assert all(kept[3][i] == kept[2][i] for i in kept[2] if i != 303)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {x["doc_id"] for x in packed.collect()} == set(kept[3])


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_rows_equal_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    want = duck.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(repr(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(map(repr, r)) for r in want.fetchall())
