"""The pipeline's stages on the small tables, each against a restatement of what it must do."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from glyphlane.llm.common import written
from tests.conftest import spark  # noqa: F401
from tests.llm.test_operators import UPPER, brute_components, crc, library_ids

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):  # noqa: F811
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    columns, states = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        states.append(written(stage(spark, states[-1], FOLDER), name.replace(" ", "-")))
    assert all(s.columns == columns for s in states[:5])
    held = [{r.doc_id: r for r in s.collect()} for s in states[:5]]
    assert all(held[k + 1].keys() <= held[k].keys() for k in range(4))

    toxic = {i for i in held[0] if i in labels and labels[i].toxic}
    clean = {i for i in held[0] if i in labels and not labels[i].toxic}
    assert len(clean & held[1].keys()) >= 0.97 * len(clean) and len(toxic - held[1].keys()) >= 0.5 * len(toxic)
    bad = {i for i in held[1] if i in labels and not labels[i].quality}
    good = {i for i in held[1] if i in labels and labels[i].quality}
    assert len(good & held[2].keys()) >= 0.97 * len(good) and len(bad - held[2].keys()) >= 0.5 * len(bad)

    lines = {}
    keys = {i: [x.strip(" \t\n\x0b\x0c\r").translate(UPPER) for x in (r.text or "").split("\n")] for i, r in held[2].items()}
    for i, some in keys.items():
        for k in some:
            lines.setdefault(k, set()).add(i)
    assert held[3].keys() == held[2].keys()
    for i, r in held[2].items():
        kept = [x for x, k in zip((r.text or "").split("\n"), keys[i]) if len(k) < 20 or len(lines[k]) < 3 or i == max(lines[k])]
        assert held[3][i].text == "\n".join(kept) and held[3][i].n_chars == len(held[3][i].text)

    ids = sorted(held[3])
    found = brute_components([held[3][i].text for i in ids], ids)
    assert held[4].keys() == {i for i in ids if found[i][1] == i}

    pieces = states[5].collect()
    ids = sorted(held[4])
    want = dict(zip(ids, library_ids([held[4][i].text for i in ids], 1)))
    for r in pieces:
        part = want[r.doc_id][r.piece * 4096 : r.piece * 4096 + 4096]
        assert (r.length, r.ids_crc32) == (len(part), crc(part))
    assert sum(r.length for r in pieces) == sum(map(len, want.values()))
    total = states[5].groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in total) <= 4096
    assert len(total) <= -(-sum(map(len, want.values())) // 4096) + 1
    assert np.array_equal(sorted((r.doc_id, r.piece) for r in corpus_pipeline.run(spark, FOLDER).collect()), sorted((r.doc_id, r.piece) for r in pieces))


def test_line_dedup_keeps_columns_named_as_its_counts(spark):  # noqa: F811
    line = "a line of more than twenty signs"
    docs = spark.createDataFrame([(i, f"{line}\n{i}", "x", i * 7) for i in range(4)], "doc_id bigint, text string, n_lines string, n_dropped bigint")
    got = corpus_pipeline.drop_repeated_lines(spark, docs, FOLDER)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(i, f"{line}\n{i}" if i == 3 else str(i), "x", i * 7) for i in range(4)]


def odd_documents(spark):  # noqa: F811
    """Nulls in every column, repeated rows and ids, ties, blanks, a very long text, and columns named as what the stages add."""
    shared = "a line of more than twenty signs that many hold"
    texts = [f"{shared}\nown words of text {i} " + " ".join(f"w{i}x{k}" for k in range(20)) for i in range(12)]
    texts += [None, "", " \n ", "long " * 100_000, texts[0], texts[0], "five words are here now", "five words are here now"]
    ids = [*range(12), 20, 21, 22, 23, 0, 30, 31, None]
    rows = [(i, t, None if n % 3 else "en", None, None if t is None else len(t), "a", n, 0.5) for n, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n_dropped string, key bigint, score double")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_any_rows(spark, name, stage):  # noqa: F811
    docs = odd_documents(spark)
    before = docs.collect()
    rows = stage(spark, docs, FOLDER)
    got = rows.collect()
    assert stage(spark, docs.limit(0), FOLDER).collect() == []
    if name == "best-fit packing":
        want = library_ids([r.text for r in before], 1)
        assert sum(r.length for r in got) == sum(map(len, want))
        return
    assert rows.columns == docs.columns
    if name == "line dedup":
        assert len(got) == len(before)
        assert sum("more than twenty" in (r.text or "") for r in got) >= 1
        assert {(r.doc_id, r.key, r.n_dropped) for r in got} == {(r.doc_id, r.key, r.n_dropped) for r in before}
    else:
        assert {tuple(r) for r in got} <= {tuple(r) for r in before}
    if name == "near dedup":
        assert {r.key for r in got if r.doc_id is None} == {19}  # rows without an id stay
        assert len({r.doc_id for r in got if r.text == before[0].text}) == 1
