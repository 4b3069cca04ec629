"""Tables that change together: atomic versions, writers that die, two writers at once."""

import os

import pytest
from pyspark.sql import functions as F

from quillfold.errors import StorageError
from quillfold.sources import commits
from quillfold.sources.commits import Conflict, VersionedTables
from quillfold.sources.registry_tables import Registry


def rows(spark, *values, schema="doc_id long, v string"):
    return spark.createDataFrame(list(values), schema)


def got(tables, name, version=None):
    df = tables.read(name, version)
    return None if df is None else sorted(map(tuple, df.collect()), key=str)


def test_replaces_documents_in_all_tables_at_once(spark, tmp_path):
    t = VersionedTables(spark, f"file://{tmp_path}/r", buckets=4)
    assert t.read("calls") is None and t.versions() == []
    assert t.publish({"calls": rows(spark, (1, "a"), (1, "b"), (2, "c"), (None, "n")), "tags": rows(spark, (1, "x"), (3, "y"))}) == 1
    # document 1 has no calls any more, document 3 changes, a null key is a key
    assert t.publish({"calls": rows(spark, (3, "d"), (None, "m")), "tags": rows(spark, (3, "z"))}, rows(spark, (1,), (3,), schema="doc_id int")) == 2
    assert got(t, "calls") == [(2, "c"), (3, "d"), (None, "m")] and got(t, "tags") == [(3, "z")]
    assert got(t, "calls", 1) == [(1, "a"), (1, "b"), (2, "c"), (None, "n")]
    again = {"calls": rows(spark, (3, "d"), (None, "m")), "tags": rows(spark, (3, "z"))}
    t.publish(again)
    assert got(t, "calls") == [(2, "c"), (3, "d"), (None, "m")]
    t.publish({"calls": rows(spark).limit(0)}, rows(spark, (2,), (3,), (None,), schema="doc_id long"))
    assert got(t, "calls") == []
    # other columns: older rows have nulls, and keep what they had
    t.publish({"tags": rows(spark, (9, 5), schema="doc_id long, n int")})
    assert [tuple(r) for r in t.read("tags").select("doc_id", "n", "v").orderBy("doc_id").collect()] == [(3, None, "z"), (9, 5, None)]


@pytest.mark.parametrize("dies", ["between tables", "before the pointer"])
def test_a_writer_that_dies_changes_nothing(spark, tmp_path, monkeypatch, dies):
    path = f"file://{tmp_path}/r"
    t = VersionedTables(spark, path, buckets=2)
    t.publish({"calls": rows(spark, (1, "a"), (2, "b")), "tags": rows(spark, (1, "x"))})
    killed = VersionedTables(spark, path, buckets=2)
    write, n = killed._written, []

    def written(df, name):
        n.append(name)
        if dies == "between tables" and name == "tags":
            raise KeyboardInterrupt
        return write(df, name)

    monkeypatch.setattr(killed, "_written", written)
    if dies != "between tables":
        monkeypatch.setattr(killed, "_commit", lambda m: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        killed.publish({"calls": rows(spark, (1, "A")), "tags": rows(spark, (1, "X"))})
    assert "calls" in n
    fresh = VersionedTables(spark, path, buckets=2)
    assert got(fresh, "calls") == [(1, "a"), (2, "b")] and got(fresh, "tags") == [(1, "x")] and fresh.versions() == [1]
    assert fresh.vacuum() > 0 and got(fresh, "calls") == [(1, "a"), (2, "b")]
    assert fresh.publish({"calls": rows(spark, (1, "A"))}) == 2 and got(fresh, "calls") == [(1, "A"), (2, "b")]


def meanwhile(monkeypatch, tables, act):
    """``act`` runs once, right before ``tables`` publishes."""
    commit, done = tables._commit, []

    def first(manifest):
        if not done:
            done.append(True)
            act()
        return commit(manifest)

    monkeypatch.setattr(tables, "_commit", first)


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/r"
    a, b = (VersionedTables(spark, path, buckets=1) for _ in range(2))
    a.publish({"calls": rows(spark, (1, "a"), (2, "b"), (3, "c"))})
    meanwhile(monkeypatch, a, lambda: b.publish({"calls": rows(spark, (2, "B"), (4, "D")), "tags": rows(spark, (2, "t"))}))
    assert a.publish({"calls": rows(spark, (3, "C"), (4, "d"))}) == 3
    # both wrote document 4: the later version has it; all else of both is there
    assert got(a, "calls") == [(1, "a"), (2, "B"), (3, "C"), (4, "d")] and got(b, "tags") == [(2, "t")]
    assert got(a, "calls", 2) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]


def test_conflicts_are_told_to_those_who_ask(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/r"
    a, b = (VersionedTables(spark, path, buckets=1) for _ in range(2))
    a.publish({"calls": rows(spark, (1, "a")), "tags": rows(spark, (1, "t"))})
    with pytest.raises(Conflict, match="version 2 changed"):
        meanwhile(monkeypatch, a, lambda: b.publish({"calls": rows(spark, (1, "B"))}))
        a.publish({"calls": rows(spark, (1, "A"))}, base=1)
    assert got(a, "calls") == [(1, "B")]
    # another table is no conflict
    meanwhile(monkeypatch, a, lambda: b.publish({"tags": rows(spark, (1, "T"))}))
    assert a.publish({"calls": rows(spark, (1, "A"))}, base=2) == 4 and got(a, "tags") == [(1, "T")]


def test_versions_are_created_once(spark, tmp_path):
    files = commits.Files(spark, f"file://{tmp_path}")
    os.makedirs(tmp_path / "v")
    assert files.create(f"file://{tmp_path}/v/1.json", "one") and not files.create(f"file://{tmp_path}/v/1.json", "two")
    assert files.text(f"file://{tmp_path}/v/1.json") == "one" and [n for n in files.names(f"file://{tmp_path}/v") if not n.startswith(".")] == ["1.json"]


def test_vacuum_keeps_the_last_versions(spark, tmp_path):
    t = VersionedTables(spark, f"file://{tmp_path}/r", buckets=2)
    for k in range(4):
        t.publish({"calls": rows(spark, (k, "v"), (100, str(k)))})
    t.vacuum(keep=2)
    assert t.versions() == [3, 4] and set(got(t, "calls")) == {(0, "v"), (1, "v"), (2, "v"), (3, "v"), (100, "3")} and (100, "2") in got(t, "calls", 3)


def test_registry_reads_one_version(spark, tmp_path):
    r = Registry(spark, f"file://{tmp_path}/r", buckets=2)
    assert r.read("summaries").count() == 0
    with pytest.raises(StorageError):
        r.read("nothing")
    r.publish({"documents": rows(spark, (1, "m")).withColumnRenamed("v", "manager_id"), "managers": rows(spark, ("m", "M"), schema="manager_id string, name string")})
    assert r.execute("select name from {documents} join {managers} using (manager_id) where doc_id = :d", d=1).first().name == "M"
    assert r.save("managers", rows(spark, ("m", "N"), schema="manager_id string, name string")) == 2
    assert [x.name for x in r.read("managers").collect()] == ["N"] and r.read("documents").select(F.max("doc_id")).first()[0] == 1
