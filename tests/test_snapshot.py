"""Published snapshots: late, repeated, changed and retried batches."""

import itertools
import random

import pytest

from litwire.streaming import daily, snapshot

SCHEMA = "id long, kind string, seen int, title string, tags map<string,string>"


def rows_of(table):
    return {(r["id"], r["kind"]): (r["seen"], r["title"], r["changed_in"]) for r in table.collect()}


def test_changes_late_and_repeated_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    put = snapshot.publish(path, ["id", "kind"], ["seen"], buckets=4)

    def batch(*rows):
        return spark.createDataFrame([(*r, {"k": r[3]}) for r in rows], SCHEMA)

    first = [(1, "a", 5, "one"), (2, "a", 5, "two"), (None, None, None, "none"), (1, "a", 4, "older")]
    put(batch(*first), 0)
    put(batch((1, "a", 6, "one"), (2, "a", 7, "second"), (3, "a", 1, "three")), 1)
    state = {(1, "a"): (6, "one", 0), (2, "a"): (7, "second", 1), (3, "a"): (1, "three", 1), (None, None): (None, "none", 0)}
    assert rows_of(snapshot.read_snapshot(spark, path)) == state
    put(batch(*first), 2)  # Repeated, and late for what came since.
    put(batch(), 3)
    assert rows_of(snapshot.read_snapshot(spark, path)) == state
    put(batch((2, "a", 6, "late"), (4, "a", 0, "late but new")), 4)
    put(batch((2, "a", 6, "late"), (4, "a", 0, "late but new")), 4)  # Run again.
    state[(4, "a")] = (0, "late but new", 4)
    assert rows_of(snapshot.read_snapshot(spark, path)) == state
    assert snapshot.changed_rows(spark, path, 2).count() == 0
    assert [r["id"] for r in snapshot.changed_rows(spark, path, 4).collect()] == [4]
    assert rows_of(snapshot.read_snapshot(spark, path, 0)) == {(1, "a"): (5, "one", 0), (2, "a"): (5, "two", 0), (None, None): (None, "none", 0)}
    # A version whose write did not end is not read.
    (tmp_path / "t" / "version=5" / "bucket=0").mkdir(parents=True)
    assert snapshot.versions(spark, path) == [0, 1, 2, 3, 4]


def test_state_does_not_depend_on_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshot, "FULL", 2)
    rng = random.Random(3)
    rows = [(rng.randrange(6), "k", rng.randrange(4), f"t{rng.randrange(3)}", {}) for _ in range(40)]
    found = []
    for n, order in enumerate(itertools.islice(itertools.permutations(range(4)), 0, 24, 11)):
        put = snapshot.publish(str(tmp_path / str(n)), ["id"], ["seen"], buckets=3)
        for number, part in enumerate(order):
            put(spark.createDataFrame(rows[part::4], SCHEMA), number)
        found.append({r["id"]: (r["seen"], r["title"]) for r in snapshot.read_snapshot(spark, str(tmp_path / str(n))).collect()})
    assert found[0] == found[1] == found[2]
    assert all(seen == max(r[2] for r in rows if r[0] == i) for i, (seen, _) in found[0].items())


def test_late_and_undated_records_of_a_stream_are_kept(spark, tmp_path):
    schema = "id long, arrived timestamp, published date"
    files = ["1,2024-01-10 00:00:00,2024-01-09\n2,2024-01-11 00:00:00,", "3,2024-01-20 00:00:00,1999-05-05", "4,2024-01-02 00:00:00,2024-01-01\n1,2024-01-10 00:00:00,2024-01-09"]
    (tmp_path / "in").mkdir()
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    for n, lines in enumerate(files):
        (tmp_path / "in" / f"{n}.csv").write_text(lines)
        stream = spark.readStream.schema(schema).csv(str(tmp_path / "in"))
        daily.upsert_batches(stream, state, snapshot.publish(path, ["id"], ["arrived"]), "append").awaitTermination()
    got = {r["id"]: (str(r["published"]), r["changed_in"]) for r in snapshot.read_snapshot(spark, path).collect()}
    assert got == {1: ("2024-01-09", 0), 2: ("None", 0), 3: ("1999-05-05", 1), 4: ("2024-01-01", 2)}


def test_reserved_columns_and_missing_table(spark, tmp_path):
    with pytest.raises(ValueError, match="bucket"):
        snapshot.publish(str(tmp_path), ["id"], [])(spark.createDataFrame([(1, 2)], "id int, bucket int"), 0)
    with pytest.raises(FileNotFoundError):
        snapshot.read_snapshot(spark, str(tmp_path / "none"))
