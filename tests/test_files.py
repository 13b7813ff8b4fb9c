import base64
import csv
import gzip
import json
import random
import tempfile
from hashlib import md5
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from glyphlane.operators.lengths import counted_once
from glyphlane.sources import ranges
from glyphlane.sources import readers as R
from glyphlane.sources import writers as W
from glyphlane.streaming import logs

from .conftest import first

TURNS = [{"from": "human", "value": "<image> é?"}, {"from": "gpt", "value": "a"}]


@pytest.fixture
def folder():
    return Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def test_samples(spark, folder):
    rows = [{"image": "a.jpg", "conversations": TURNS}, {"images": ["a", "b"], "video": "v.mp4", "conversations": TURNS, "num_tokens": 5}]
    (folder / "a.json").write_text(json.dumps(rows, indent=1))
    (folder / "a.jsonl").write_text("\n".join(json.dumps(r) for r in rows))
    for name in ("a.json", "a.jsonl"):
        got = R.read_samples(spark, str(folder / name), data_path="/d").collect()
        assert sorted((len(r.images), r.videos, r.num_tokens) for r in got) == [(1, [], None), (2, ["v.mp4"], 5)]
        assert {r.data_path for r in got} == {"/d"} and got[0].conversations[0].value == "<image> é?"
    (folder / "p.json").write_text(json.dumps([[rows[0], rows[1]], [rows[0]]]))
    packed = R.read_packed_samples(spark, str(folder / "p.json")).collect()
    assert sorted((r.pack_id, r.pos_in_pack, len(r.images)) for r in packed) == [(0, 0, 1), (0, 1, 2), (1, 0, 1)]


def test_tables(spark, folder):
    cell = '[{"role": "user", "content": "two\nlines, \\"quoted\\""}]'
    with open(folder / "log.csv", "w", newline="") as f:
        csv.writer(f).writerows([["messages", "image_payload_id", "total_tokens"], [cell, "007", "12"], ["", "", ""]])
    got = R.read_log(spark, str(folder / "log.csv")).collect()
    assert got[0].messages == cell and got[0].image_payload_id == "007" and got[1].image_payload_id is None
    big = base64.b64encode(b"x" * 2_000_000).decode()
    (folder / "b.tsv").write_text(f"index\tquestion\timage\n1\tq\t{big}\n")
    assert first(R.read_benchmark(spark, str(folder / "b.tsv"))).image == big
    with gzip.open(folder / "c.jsonl.gz", "wt") as f:
        f.write(json.dumps({"question": "q", "images": ["i"], "starter_code": "", "input_output": "{}"}) + "\n")
    assert first(R.read_code_problems(spark, str(folder / "c.jsonl.gz"))).question == "q"


@pytest.fixture
def small_ranges(spark):
    """Files are cut into ranges of 200 bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "200")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def _odd_cells(rnd):
    return "".join(rnd.choice(["a", '"', "\n", ",", "\t", " ", "é", "", "{", "}", "]", "\\", "\r\n", "x" * 40]) for _ in range(rnd.randint(0, 12)))


@pytest.mark.parametrize("separator", [",", "\t"])
def test_large_tables_are_read_by_ranges(spark, folder, small_ranges, separator):
    rnd = random.Random(5)
    rows = [[str(i), _odd_cells(rnd), "z" + _odd_cells(rnd)] for i in range(300)]
    rows[150][1] = "long\n" * 400  # spans many ranges
    for name, part in (("a.csv", rows[:200]), ("b.csv", rows[200:])):
        with open(folder / name, "w", newline="") as f:
            csv.writer(f, delimiter=separator).writerows([["id", "first", "rest"], *part])
    pieces = ranges._pieces(spark, str(folder), ranges.TABLE)
    assert pieces.select("file", "start").distinct().count() > 40 and pieces.rdd.getNumPartitions() > 4
    got = R.read_table(spark, str(folder), separator)
    assert got.columns == ["id", "first", "rest"]
    want = spark.read.csv(str(folder), sep=separator, header=True, multiLine=True, escape='"', quote='"')
    # Spark's own reader turns line ends within cells into plain ones
    shown = lambda rows: sorted(tuple(None if c is None else c.replace("\r\n", "\n") for c in r) for r in rows.collect())
    assert shown(got.fillna("")) == shown(want.fillna(""))
    assert {r.id: r.rest for r in got.collect()} == {i: rest for i, _, rest in rows}


def test_large_arrays_are_read_by_ranges(spark, folder, small_ranges):
    rnd = random.Random(6)
    rows = [{"image": f"{i}.jpg", "conversations": [{"from": "human", "value": _odd_cells(rnd) + "}" * (i % 3)}], "num_tokens": i} for i in range(300)]
    rows[150]["conversations"] *= 100
    (folder / "a.json").write_text(json.dumps(rows[:200], indent=1, ensure_ascii=False))
    (folder / "b.json").write_text(json.dumps(rows[200:]))
    (folder / "c.json").write_text(" [ ]\n")
    got = R.read_samples(spark, str(folder / "*.json"), lines=False).collect()
    assert {r.num_tokens: [t.value for t in r.conversations] for r in got} == {r["num_tokens"]: [t["value"] for t in r["conversations"]] for r in rows}
    assert len(got) == 300


def test_ranges_beyond_the_broadcast(spark, folder, small_ranges, monkeypatch):
    monkeypatch.setattr(ranges, "BROADCAST_RANGES", 0)
    rows = [[str(i), "line\n" * (i % 7)] for i in range(200)]
    with open(folder / "a.csv", "w", newline="") as f:
        csv.writer(f).writerows([["id", "text"], *rows])
    assert {r.id: r.text or "" for r in R.read_log(spark, str(folder / "a.csv")).collect()} == {i: t for i, t in rows}


def test_written_tables_have_one_header(spark, folder):
    rows = spark.createDataFrame([(i, f" a\n\"{i}\" ,") for i in range(50)], "i int, t string").repartition(3)
    path = str(folder / "t")
    W.write_table(rows, path)
    W.write_table(rows, path, mode="append")
    text = "".join(p.read_text() for p in sorted((folder / "t").glob("*/part-*.txt")))
    assert text.startswith("i,t\n") and text.count("i,t\n") == 1
    assert len(list(csv.reader(text.splitlines(keepends=True)))) == 101
    assert sorted((r.i, r.t) for r in R.read_table(spark, path).collect()) == sorted((str(i), f" a\n\"{i}\" ,") for i in list(range(50)) * 2)
    W.write_json_array(rows, str(folder / "j"))
    parts = [json.loads(p.read_text()) for p in (folder / "j").glob("part-*.txt")]
    assert sorted(r["i"] for p in parts for r in p) == list(range(50))


def test_annotation_files_are_parsed_once(spark, folder):
    (folder / "coco.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "a", "height": 2, "width": 3}], "annotations": [], "categories": None}))
    parts = R.read_coco(spark, str(folder / "coco.json"))
    assert [parts[p].count() for p in R.COCO_PARTS] == [1, 0, 0] and first(parts["images"]).file_name == "a"
    assert all("FileScan parquet" in d._jdf.queryExecution().toString() and "from_json" not in d._jdf.queryExecution().toString() for d in parts.values())


def test_annotations_and_small_files(spark, folder):
    (folder / "coco.json").write_text(json.dumps({
        "images": [{"id": 1, "file_name": "a", "height": 2, "width": 3}], "categories": [{"id": 9, "name": "cat"}],
        "annotations": [{"id": 5, "image_id": 1, "category_id": 9, "bbox": [1, 2, 3, 4], "area": 12, "iscrowd": 0}]}))
    coco = R.read_coco(spark, str(folder / "coco.json"))
    assert first(coco["annotations"]).bbox == [1, 2, 3, 4] and first(coco["categories"]).name == "cat"
    (folder / "cams.json").write_text(json.dumps({"a": {"fx": 1, "fy": 2, "cx": 3, "cy": 4}}))
    images = spark.createDataFrame([("a",), ("b",)], "image string")
    assert {r.image: r.fx for r in R.with_cameras(images, R.read_cameras(spark, str(folder / "cams.json"))).collect()} == {"a": 1.0, "b": None}
    (folder / "ids.json").write_text('["x", "y", "x"]')
    assert sorted(r.image_id for r in R.read_wanted_ids(spark, str(folder / "ids.json")).collect()) == ["x", "y"]
    (folder / "cfg.jsonl").write_text(json.dumps({"name": "d", "classes": ["a"], "data_root": "r"}))
    assert first(R.read_dataset_configs(spark, str(folder / "cfg.jsonl"))).classes == ["a"]


def test_media_listing_and_checksums(spark, folder):
    for name in ("a.jpg", "b.PNG", "c.txt"):
        (folder / name).write_bytes(name.encode())
    assert sorted(r.stem for r in R.list_media(spark, str(folder)).collect()) == ["a", "b"]
    manifest = spark.createDataFrame([("a.jpg", md5(b"a.jpg").hexdigest()), ("b.PNG", "other"), ("gone", "x")], "name string, md5 string")
    assert sorted(r.name for r in R.stale_files(spark, str(folder), manifest).collect()) == ["b.PNG", "gone"]


def test_writers(spark, folder):
    df = spark.createDataFrame([("é\x01", 1)], "s string, n int")
    W.write_json_lines(df, str(folder / "j"))
    assert spark.read.json(str(folder / "j")).collect()[0].s == "é\x01"
    W.write_table(W.without_control_characters(df), str(folder / "t"))
    assert first(R.read_table(spark, str(folder / "t"))).s == "é"
    W.write_summary(df.select("n"), str(folder / "s"))
    assert first(spark.read.text(str(folder / "s"))).value == '{"n":1}'
    rows = spark.createDataFrame([("1", base64.b64encode(b"pic").decode())], "index string, image string")
    W.write_new_images(W.encoded_images(rows, "index", "image"), spark.createDataFrame([], "path string"), str(folder / "i"))
    W.write_new_images(W.encoded_images(rows, "index", "image"), spark.read.parquet(str(folder / "i")).select("path"), str(folder / "i"))
    assert [(r.path, bytes(r.content)) for r in spark.read.parquet(str(folder / "i")).collect()] == [("1.jpg", b"pic")]


def test_counts_are_reused(spark):
    samples = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    known = spark.createDataFrame([(2, 50)], "id int, num_tokens int")
    got = counted_once(samples, known, "id", lambda fresh: fresh.withColumn("num_tokens", F.lit(7)))
    assert {r.id: r.num_tokens for r in got.collect()} == {1: 7, 2: 50, 3: 7}


def test_log_stream(spark, folder):
    source = folder / "in"
    source.mkdir()
    for n in range(3):
        with open(source / f"{n}.csv", "w", newline="") as f:
            csv.writer(f).writerows([["messages", "image_payload_id", "total_tokens"],
                                     [f"[{{'role': 'user', 'content': 'a<browser_state>x</browser_state>{n}'}}]", "1", "2"]])
    query = logs.convert_log_stream(logs.read_log_stream(spark, str(source), 1), str(folder / "out"), str(folder / "cp"))
    query.awaitTermination(120)
    got = spark.read.parquet(str(folder / "out"))
    assert sorted(r.messages for r in got.collect()) == [f"[{{'role': 'user', 'content': 'a{n}'}}]" for n in range(3)]
