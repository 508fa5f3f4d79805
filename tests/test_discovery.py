import os

import pytest
from pyspark.sql import functions as F

from docmeld.operators.documents import parse_documents
from docmeld.sources import discovery
from docmeld.sources.discovery import FileDiscovery, FolderListing, located, patterns
from docmeld.streaming.pipeline import Pipeline
from docmeld.workspace import names


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    for sub in ("", "a", "a/deep", "b"):
        (folder / sub).mkdir(parents=True, exist_ok=True)
        for k in range(5):
            (folder / sub / f"{k}.pdf").write_bytes(f"{sub}:{k} ".encode() * (k + 1))
    (folder / "a" / "other.txt").write_bytes(b"not wanted")
    (folder / "b" / "_hidden.pdf").write_bytes(b"not wanted")
    return folder


def taken(spark, discovery, target, checkpoint):
    """What a run takes, as number of files and bytes per micro-batch."""
    sizes = []

    def write(rows, batch):
        rows.write.mode("overwrite").parquet(f"{target}/{batch:012d}")
        got = spark.read.parquet(f"{target}/{batch:012d}").agg(F.count(F.lit(1)), F.sum("length")).first()
        sizes.extend([tuple(got)] if got[0] else [])

    run = discovery.arriving().writeStream.foreachBatch(write).option("checkpointLocation", str(checkpoint))
    run.trigger(availableNow=True).start().awaitTermination()
    return sizes


def contents(spark, target):
    rows = spark.read.option("recursiveFileLookup", "true").parquet(str(target)).collect()
    return sorted((r.path, bytes(r.content)) for r in rows)


def wanted(inbox):
    return sorted((f"file:{p}", p.read_bytes()) for p in inbox.rglob("*.pdf") if not p.name.startswith("_"))


def test_each_file_is_taken_once_late_and_restored_ones_too(spark, tmp_path, inbox):
    found = FileDiscovery(spark, str(inbox), str(tmp_path / "state"), max_files=12)
    target = tmp_path / "taken"
    assert sorted(n for n, _ in taken(spark, found, target, tmp_path / "c")) == [8, 12]
    assert contents(spark, target) == wanted(inbox)
    assert taken(spark, found, target, tmp_path / "c") == []
    late = inbox / "a" / "deep" / "late.PDF"
    late.write_bytes(b"an old stamp")
    os.utime(late, (1, 1))
    (inbox / "new").mkdir()
    (inbox / "new" / "x.tif").write_bytes(b"")
    (inbox / "b" / "0.pdf").write_bytes(b"changed, but taken before")
    # by another object and another name of the folder
    found = FileDiscovery(spark, f"file://{inbox}", str(tmp_path / "state"), max_files=1000)
    assert taken(spark, found, target, tmp_path / "c") == [(2, 12)]
    assert found.seen().count() == 22


def test_same_rows_as_the_file_source(spark, tmp_path, inbox):
    from docmeld.sources.files import binary_file_stream

    out = []
    for k, stream in enumerate((binary_file_stream(spark, str(inbox), recursive=True), FileDiscovery(spark, str(inbox), str(tmp_path / "s")).arriving())):
        run = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"c{k}"))
        run.trigger(availableNow=True).start(str(tmp_path / f"o{k}")).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / f"o{k}")).withColumn("modificationTime", F.unix_millis("modificationTime"))
        out.append(sorted(map(tuple, rows.collect())))
    assert out[0] == out[1] and len(out[0]) == 20


@pytest.mark.parametrize(("files", "size"), [(3, "1g"), (1000, 40), (4, 60), (1000, 1)])
def test_both_limits_hold(spark, tmp_path, inbox, files, size):
    found = FileDiscovery(spark, str(inbox), str(tmp_path / "s"), max_files=files, max_bytes=size)
    most = discovery.parse_bytes(size)
    found.discover()
    lots = [tuple(r) for r in found.seen().groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n"), F.sum("length")).select("n", "sum(length)").collect()]
    assert sum(n for n, _ in lots) == 20 and all(n <= files and (b <= most or n == 1) for n, b in lots)
    # greedy lots: no two neighbours would have fitted into one, but for the ends of tasks
    assert len(lots) <= 2 * max(20 / files, sum(b for _, b in lots) / most) + 1 or most == 1


def test_only_changed_folders_are_handed_on(spark, tmp_path, inbox):
    found = FileDiscovery(spark, str(inbox), str(tmp_path / "s"), depth=2)
    found.discover()
    (inbox / "b" / "9.pdf").write_bytes(b"x")
    reader = FolderListing({"path": str(inbox), "state": str(tmp_path / "s"), "glob": "*.pdf", "depth": "2", "tasks": "3"}).streamReader(None)
    rows = [r for p in reader.partitions({}, {}) for r in reader.read(p)]
    assert {r[0] for r in rows} == {str(inbox / "b")} and sum(r[1] is not None for r in rows) == 6
    assert [n for n in names(spark, str(tmp_path / "s" / "marks"))] == ["000000000000"]


def test_a_batch_that_failed_before_its_end_is_done_again(spark, tmp_path, inbox, monkeypatch):
    """The marks are written but the files are not: the next run must not take the folders for quiet."""
    found = FileDiscovery(spark, str(inbox), str(tmp_path / "s"))
    with monkeypatch.context() as m, pytest.raises(Exception, match="lost"):
        m.setattr(FileDiscovery, "_lots", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        found.discover()
    assert found.seen().count() == 0
    (inbox / "more.pdf").write_bytes(b"x")
    found.discover()
    assert found.seen().count() == 21


def test_a_complete_batch_that_runs_again_changes_nothing(spark, tmp_path, inbox):
    found = FileDiscovery(spark, str(inbox), str(tmp_path / "s"))
    found.discover()
    before = {str(p) for p in (tmp_path / "s" / "seen").rglob("*.parquet")}
    found._take(spark.createDataFrame([], discovery.LISTING), 0)
    assert {str(p) for p in (tmp_path / "s" / "seen").rglob("*.parquet")} == before


def test_no_folder_and_no_files(spark, tmp_path):
    found = FileDiscovery(spark, str(tmp_path / "nowhere"), str(tmp_path / "s"))
    assert taken(spark, found, tmp_path / "t", tmp_path / "c") == [] and found.seen().count() == 0


def test_pipeline_over_discovered_files(spark, tmp_path):
    (tmp_path / "in" / "day1").mkdir(parents=True)
    (tmp_path / "in" / "day1" / "a.pdf").write_bytes(b"First name: Ann\nLast name: Lee\n" + b"note " * 12)
    found = FileDiscovery(spark, str(tmp_path / "in"), str(tmp_path / "s"))
    none = spark.createDataFrame([], "member_id string, first_name string, last_name string, ssn4 string, dob date")
    auths = spark.createDataFrame([], "auth_id string, auth_number string, member_id string, status string")
    pipeline = Pipeline(spark, str(tmp_path / "tables"), lambda: parse_documents(found.arriving()), none, auths)
    pipeline.run(tables=("structured",))
    assert pipeline.table("structured").count() == 1
    (tmp_path / "in" / "day1" / "b.pdf").write_bytes(b"First name: Bob\nLast name: Ray\n" + b"note " * 12)
    pipeline.run(tables=("structured",))
    assert pipeline.table("structured").count() == 2
    pipeline.run("full", tables=("structured",))
    assert pipeline.table("structured").count() == 2


def test_names(tmp_path):
    assert patterns("*.{pdf,PDF}") == ["*.pdf", "*.PDF"] and patterns("a{1,2}{x,y}") == ["a1x", "a1y", "a2x", "a2y"]
    for uri in (f"{tmp_path}/", f"file:{tmp_path}", f"file://{tmp_path}"):
        assert located(uri)[1:] == (str(tmp_path), "file:")


def test_a_folder_without_a_mark_is_walked_once(tmp_path, inbox, monkeypatch):
    options = {"path": str(inbox), "state": str(tmp_path / "state"), "glob": "*.pdf", "depth": "1", "tasks": "1"}
    listing, walked, walk = discovery.Listing(options), [], discovery.Listing.walk
    monkeypatch.setattr(discovery.Listing, "walk", lambda self, fs, folder, below: walked.append(folder) or walk(self, fs, folder, below))
    folder = str(inbox / "b")
    rows = list(listing.read(discovery.Prefixes([(folder, True, None)])))
    assert len(rows) == 6 and rows[-1][4] == 5 and walked == [folder]
    mark = rows[-1][4:]
    assert not list(listing.read(discovery.Prefixes([(folder, True, mark)]))) and len(walked) == 2
    assert len(list(listing.read(discovery.Prefixes([(folder, True, (4, 0))])))) == 6 and len(walked) == 4
    (tmp_path / "none").mkdir()
    assert not list(listing.read(discovery.Prefixes([(str(tmp_path / "none"), True, None)])))
