"""Readers of published and audited tables, between any two steps."""

import os
import shutil
import subprocess
import sys
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from wayfleet.operators.quality import Checks
from wayfleet.schemas import record
from wayfleet.sinks import audited, published
from wayfleet.sinks.published import Published

SCHEMA = record(id="bigint", value="double", day="string")
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def table_of(spark):
    return Published(f"db_{uuid.uuid4().hex[:8]}", "readings", SCHEMA, ["day"], tempfile.mkdtemp(prefix="run-"))


def rows(spark, *of):
    return spark.createDataFrame(list(of), SCHEMA)


def ids(spark, table):
    return sorted(r.id for r in published.read(spark, table).collect())


def test_reader_between_steps_sees_each_row_once(spark, monkeypatch):
    """Rows move to another day, a day empties, names need quoting; a reader after every statement sees the old rows or the new ones, whole."""
    table, run, seen = table_of(spark), published._sql, []
    published.publish(rows(spark, (1, 1.0, "a"), (2, 2.0, "a"), (3, 3.0, "it's b/c:d"), (4, 4.0, "e")), table)

    def watched(session, text):
        out = run(session, text)
        if not text.startswith("SHOW"):
            seen.append(sorted((r.id, r.value, r.day) for r in published.read(session, table).collect()))
        return out

    monkeypatch.setattr(published, "_sql", watched)
    old = sorted((r.id, r.value, r.day) for r in published.read(spark, table).collect())
    published.publish(rows(spark, (1, 1.0, "e"), (3, 3.5, "e"), (4, 4.0, "e"), (2, 2.0, "f")), table, rows(spark, (0, 0.0, "a"), (0, 0.0, "it's b/c:d"), (0, 0.0, "e")).select("day"))
    new = [(1, 1.0, "e"), (2, 2.0, "f"), (3, 3.5, "e"), (4, 4.0, "e")]
    assert len(seen) >= 5 and all(s in (old, new) for s in seen) and seen[-1] == new
    # A third one, on the side that lags by one publication.
    published.publish(rows(spark, (9, 9.0, "f"), (2, 2.0, "f")), table)
    assert ids(spark, table) == [1, 2, 3, 4, 9] and published.version(spark, table) == 3


@pytest.mark.parametrize("stop", [1, 2, 3])
def test_interrupted_publication_is_repeated(spark, monkeypatch, stop):
    table, run, left = table_of(spark), published._sql, [stop]
    published.publish(rows(spark, (1, 1.0, "a"), (2, 2.0, "b")), table)

    def failing(session, text):
        if text.startswith(("ALTER", "CREATE OR REPLACE")):
            left[0] -= 1
            if not left[0]:
                raise RuntimeError("stopped")
        return run(session, text)

    monkeypatch.setattr(published, "_sql", failing)
    fresh = rows(spark, (1, 1.0, "b"), (2, 2.0, "b")), table, rows(spark, (0, 0.0, "a")).select("day")
    with pytest.raises(RuntimeError):
        published.publish(*fresh)
    assert ids(spark, table) == [1, 2] and published.read(spark, table).filter("day = 'a'").count() == 1
    monkeypatch.setattr(published, "_sql", run)
    assert published.publish(*fresh) == 2
    assert ids(spark, table) == [1, 2] and published.read(spark, table).filter("day = 'a'").count() == 0


def test_compaction_and_tidying(spark):
    table = table_of(spark)
    for i in range(3):
        published.publish(published.read(spark, table).filter("day = 'a'").unionByName(rows(spark, (i, float(i), "a"))), table)
    published.publish(rows(spark, *[(100 + i, 0.0, "b") for i in range(50)]).repartition(8), table)
    published.compact(spark, table, F.col("day") == "b")
    published.compact(spark, table, F.col("day") == "b")
    assert len(ids(spark, table)) == 53
    files = {r[0] for r in published.read(spark, table).filter("day = 'b'").select(F.input_file_name()).collect()}
    assert len(files) == 1
    loose = published.tidy(spark, table)
    assert loose and len(ids(spark, table)) == 53
    with pytest.raises(Exception):
        published.compact(spark, table, F.col("value") > 0)
    with pytest.raises(ValueError):
        published.publish(rows(spark, (1, 1.0, None)), table)
    assert len(ids(spark, table)) == 53


CHECKS = Checks(required=("value",), ranges={"value": (0, 100)}, unique="id", nested=())


def test_refused_versions_stay_hidden(spark):
    root = tempfile.mkdtemp(prefix="run-")
    assert audited.current(spark, root, SCHEMA).collect() == [] and audited.verdicts(spark, root) is None
    assert not audited.publish_audited(rows(spark), root, CHECKS, ["id"]), "an empty version is refused"
    assert audited.publish_audited(rows(spark, (1, 1.0, "a"), (2, 2.0, "a")), root, CHECKS, ["id"], ["day"])
    assert not audited.publish_audited(rows(spark, (1, 1.0, "a"), (1, 5.0, "b")), root, CHECKS, ["id"])
    assert sorted(r.id for r in audited.current(spark, root, SCHEMA).collect()) == [1, 2]
    # A version worked out from the current one replaces it.
    assert audited.publish_audited(audited.current(spark, root, SCHEMA).unionByName(rows(spark, (3, 3.0, "c"))), root, CHECKS, ["id"])
    found = {r.version: (r.verdict, r.repeated_keys, r.record_count) for r in audited.verdicts(spark, root).collect()}
    assert found == {1: ("refused", 0, 0), 2: ("published", 0, 2), 3: ("refused", 1, 2), 4: ("published", 0, 3)}
    audited.drop_refused(spark, root, keep=1)
    assert sorted(r.id for r in audited.current(spark, root, SCHEMA).collect()) == [1, 2, 3]


def test_audit_that_stopped_is_finished(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="run-")
    audited.publish_audited(rows(spark, (1, 1.0, "a")), root, CHECKS, ["id"])
    judge = audited._judge
    monkeypatch.setattr(audited, "_judge", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        audited.publish_audited(rows(spark, (2, 2.0, "a")), root, CHECKS, ["id"])
    monkeypatch.setattr(audited, "_judge", judge)
    assert [r.id for r in audited.current(spark, root, SCHEMA).collect()] == [1]
    os.makedirs(f"{root}/data/version=000003")
    assert audited.finish_audits(spark, root, SCHEMA, CHECKS, ["id"]) == [2]
    assert [r.id for r in audited.current(spark, root, SCHEMA).collect()] == [2]


def test_rest_imports_without_text_operators():
    """A copy without the folders of the text operators imports and still has all other queries."""
    copy = tempfile.mkdtemp(prefix="run-")
    shutil.copytree(ROOT, f"{copy}/r", ignore=lambda folder, names: [n for n in names if n in (".git", "llm", "__pycache__")])
    code = "import __spark_entry__ as e; n = e.queries(); print(len(n), 'pipeline' in n, any(k.startswith('op1') for k in n), set(e.oracle_sql()) <= set(n))"
    out = subprocess.run([sys.executable, "-c", code], cwd=f"{copy}/r", capture_output=True, text=True, timeout=120)
    count, *rest = out.stdout.split()
    assert int(count) > 90 and rest == ["False", "False", "True"], out.stderr
