"""JSON array files read in splits of any size."""

from __future__ import annotations

import json
import random

import pyarrow as pa
import pytest

from cratebook.sources import arrays


def texts(seed, n=60):
    rng = random.Random(seed)
    marks = ['plain', 'brace } and { in text', 'quote " here', 'back\\slash', 'end \\" }', '[x]', 'é日😀', '\n\t', '}', '"', '\\\\', ', {']
    return [{"k": i, "t": rng.choice(marks) + rng.choice(marks), "nested": {"a": [{"b": rng.choice(marks)}, []], "c": {}}} for i in range(n)]


@pytest.fixture
def split(spark):
    settings = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": 1}

    def to(size):
        for name, value in settings.items():
            spark.conf.set(name, str(size if value is None else value))

    yield to
    for name in settings:
        spark.conf.unset(name)


def read(spark, folder, pattern="*.json", **options):
    return sorted(json.dumps(json.loads(r["value"]), sort_keys=True) for r in arrays.records(spark, str(folder), pattern, **options).collect())


def wanted(rows):
    return sorted(json.dumps(r, sort_keys=True) for r in rows)


@pytest.mark.parametrize("size", [37, 400, 5000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_in_splits(spark, tmp_path, split, size, indent):
    rows = texts(size)
    for k in range(3):
        (tmp_path / f"f{k}.json").write_text(json.dumps(rows[k::3], indent=indent, ensure_ascii=k == 1))
    (tmp_path / "other.txt").write_text('[{"no": 1}]')
    split(size)
    assert read(spark, tmp_path) == wanted(rows)


def test_a_file_is_read_by_several_tasks(spark, tmp_path, split):
    rows = texts(1, 500)
    (tmp_path / "one.json").write_text(json.dumps(rows))
    split(4000)
    found = arrays.records(spark, str(tmp_path), "*.json")
    assert found.rdd.getNumPartitions() > 10
    assert read(spark, tmp_path) == wanted(rows)


@pytest.mark.parametrize("size", [50, 1 << 20])
def test_objects_one_after_another(spark, tmp_path, split, size):
    rows = texts(2)
    (tmp_path / "a.json").write_text("\n".join(json.dumps(r) for r in rows[:30]))
    (tmp_path / "b.json").write_text("".join(json.dumps(r, indent=1) for r in rows[30:]))
    split(size)
    assert read(spark, tmp_path, array=False) == wanted(rows)


@pytest.mark.parametrize(
    ("text", "count"), [("", 0), ("[]", 0), (" [ ] \n", 0), ('[{"a": 1}', 1), ('[{"a": 1}, {"b', 1), ('[{}]', 1), ("[{},\n{}]\n", 2)]
)
def test_odd_files(spark, tmp_path, text, count):
    (tmp_path / "x.json").write_text(text)
    assert arrays.records(spark, str(tmp_path), "*.json").count() == count


def test_no_file(spark, tmp_path):
    assert arrays.records(spark, str(tmp_path), "none.json").count() == 0


def test_a_batch_is_looked_at_whole():
    """Pieces of several splits in one batch, with escapes, and a split over two batches."""
    rows = [("a", 0, '[{"x": "\\\\\\"{"'), ("a", 0, ',{"y": [1'), ("a", 40, "]"), ("b", 0, "")]
    columns = [pa.array(c) for c in zip(*rows, strict=True)]
    batch = pa.record_batch([columns[0], columns[1].cast(pa.int64()), columns[2]], ["file", "start", "value"])
    found = [(place, text.tobytes(), list(ends)) for place, text, ends in arrays._pieces(batch)]
    assert found == [(("a", 0), b'[{"x": "\\\\\\"{"},{"y": [1}', [15, 25]), (("a", 40), b"]}", [2]), (("b", 0), b"}", [1])]
    reports = pa.Table.from_batches(arrays._reports(iter([batch.slice(0, 1), batch.slice(1)]))).to_pylist()
    assert [tuple(r.values()) for r in reports] == [
        ("a", 0, False, True, 2, 1), ("a", 40, False, True, -2, 0), ("b", 0, False, True, -1, 0),
    ]
