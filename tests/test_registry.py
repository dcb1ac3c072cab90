import hashlib

from invoicelake.operators import registry
from invoicelake.schemas import DOCUMENTS
from invoicelake.sources import files, registry_store

NOW = "2026-03-04T05:06:07+00:00"


def prints(spark, *rows):
    data = [(path, 3, digest, None if digest else "unreadable") for path, digest in rows]
    return spark.createDataFrame(data, files.PRINTS)


def by_path(df):
    return {r.source_path: r for r in df.collect()}


def test_batch_copy_points_to_smallest_path(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    out = by_path(registry.register(prints(spark, ("b/2.png", "x"), ("a/1.PNG", "x"), ("c.png", "y")), empty, run_time=NOW))
    assert out["a/1.PNG"].status == "INGESTED" and out["c.png"].status == "INGESTED"
    assert out["b/2.png"].status == "DUPLICATE_EXACT" and out["b/2.png"].duplicate_of == out["a/1.PNG"].doc_id
    assert out["b/2.png"].bronze_path is None
    assert out["a/1.PNG"].bronze_path == f"bronze/ingest_date=2026-03-04/{out['a/1.PNG'].doc_id}.png"
    assert out["a/1.PNG"].file_name == "1.PNG" and out["a/1.PNG"].size_bytes == 3


def test_second_run_skips_retries_and_sees_new_content(spark):
    first = registry.register(prints(spark, ("a.png", "x"), ("bad.png", None)), spark.createDataFrame([], DOCUMENTS),
                              run_time=NOW)
    batch = prints(spark, ("a.png", "x"), ("bad.png", "z"), ("a2.png", "x"), ("c.png", "x2"))
    second = registry.register(batch, first, run_time=NOW)
    out = by_path(second)
    assert set(out) == {"bad.png", "a2.png", "c.png"}           # known path and content skipped, failure retried
    assert out["bad.png"].status == "INGESTED"
    assert out["a2.png"].duplicate_of == by_path(first)["a.png"].doc_id
    changed = registry.register(prints(spark, ("a.png", "new")), first, run_time=NOW)
    assert by_path(changed)["a.png"].status == "INGESTED"      # same path, new content
    counts = {r.status: r.n for r in registry.run_counts(batch, second).collect()}
    assert counts == {"INGESTED": 2, "DUPLICATE_EXACT": 1, "SKIPPED": 1, "FAILED": 0}


def test_failed_file_keeps_its_row(spark):
    out = by_path(registry.register(prints(spark, ("bad.png", None)), spark.createDataFrame([], DOCUMENTS), run_time=NOW))
    assert out["bad.png"].status == "FAILED" and out["bad.png"].error_message == "unreadable"
    assert out["bad.png"].duplicate_of is None and out["bad.png"].bronze_path is None


def test_one_content_in_most_files(spark):
    many = [(f"p{i:04d}.png", "hot" if i % 3 else f"d{i}") for i in range(600)]
    out = registry.register(prints(spark, *many), spark.createDataFrame([], DOCUMENTS), run_time=NOW)
    first = by_path(out)["p0001.png"]
    assert first.status == "INGESTED"
    assert out.filter(f"duplicate_of = '{first.doc_id}'").count() == 399


def test_files_are_listed_hashed_and_failures_kept(spark, tmp_path):
    for name, data in [("b.PNG", b"one"), ("a.tiff", b"two"), ("note.txt", b"x"), ("c.pdf", b"")]:
        (tmp_path / name).write_bytes(data)
    listing = files.list_files(spark, str(tmp_path))
    names = {r[0].rsplit("/", 1)[1] for r in listing.select("path").collect()}
    assert names == {"b.PNG", "a.tiff", "c.pdf"}
    gone = spark.createDataFrame([(f"file:{tmp_path}/missing.png", 5)], "path string, length long")
    got = {r.path.rsplit("/", 1)[1]: r for r in files.fingerprint_files(listing.union(gone)).collect()}
    assert got["b.PNG"].sha256 == hashlib.sha256(b"one").hexdigest()
    assert got["c.pdf"].sha256 == hashlib.sha256(b"").hexdigest() and got["c.pdf"].length == 0
    assert got["missing.png"].sha256 is None and got["missing.png"].error_message
    native = {r.path.rsplit("/", 1)[1]: r.sha256
              for r in files.fingerprint_content(files.read_files(spark, str(tmp_path))).collect()}
    assert native == {k: got[k].sha256 for k in ("b.PNG", "a.tiff")}     # Spark itself lists no empty file
    again = files.fingerprint_files(files.read_files(spark, f"file:{tmp_path}"))
    assert {r.sha256 for r in again.collect()} == set(native.values())


def test_pending_ignores_null_keys(spark):
    reg = spark.createDataFrame([("1", "INGESTED"), ("2", "INGESTED"), ("3", "FAILED")], "doc_id string, status string")
    done = spark.createDataFrame([("1",), (None,)], "doc_id string")
    assert [r.doc_id for r in registry.pending(reg, done).collect()] == ["2"]


def test_one_spelling_per_file(spark):
    assert files.normal_path("file:///x/a%20b.png") == files.normal_path("/x/a b.png") == "/x/a b.png"
    rows = spark.createDataFrame([("file:///x/a%20b+%2B.png",), ("file:/x/c.png",), ("/x/50%25.png",), ("s3://b/k",)], "path string")
    assert [r.path for r in files.with_normal_path(rows).collect()] == ["/x/a b++.png", "/x/c.png", "/x/50%25.png", "s3://b/k"]


def test_subfolders_and_spaces(spark, tmp_path):
    (tmp_path / "a b" / "c").mkdir(parents=True)
    for name in ("top.png", "a b/one two.png", "a b/c/deep.pdf", "a b/c/x.txt"):
        (tmp_path / name).write_bytes(name.encode())
    for folder in (str(tmp_path), f"file://{tmp_path}".replace(" ", "%20")):
        listing = files.list_files(spark, folder)
        assert {r.path for r in listing.collect()} == {f"{tmp_path}/{n}" for n in ("top.png", "a b/one two.png", "a b/c/deep.pdf")}
        assert files.fingerprint_files(listing).filter("sha256 IS NULL").count() == 0


def test_a_file_that_goes_fails_alone_and_landing_again_changes_nothing(spark, tmp_path):
    for name in ("a.png", "b.png"):
        (tmp_path / name).write_bytes(name.encode())
    folder, landing = str(tmp_path), str(tmp_path / "landing")
    rows = registry.register(files.fingerprint_files(files.list_files(spark, folder)), spark.createDataFrame([], DOCUMENTS), run_time=NOW)
    (tmp_path / "b.png").unlink()
    failures = files.land(rows, landing)
    out = by_path(registry.with_failures(rows, failures))
    assert out[f"{folder}/a.png"].status == "INGESTED" and out[f"{folder}/b.png"].status == "FAILED"
    assert out[f"{folder}/b.png"].error_message and out[f"{folder}/b.png"].bronze_path is None
    (tmp_path / "b.png").write_bytes(b"b.png")
    for _ in range(2):
        assert files.land(rows, landing).count() == 0
    assert {bytes(r.content) for r in files.landed(spark, landing).collect()} == {b"a.png", b"b.png"}
    assert files.landed(spark, landing).count() == 2


def test_a_small_batch_reads_only_its_prefixes(spark, tmp_path):
    path, digest = str(tmp_path / "r"), lambda k: hashlib.sha256(str(k).encode()).hexdigest()
    empty = spark.createDataFrame([], DOCUMENTS)
    known = registry.register(prints(spark, *((f"p{k}.png", digest(k)) for k in range(500)), ("bad.png", None)), empty, run_time=NOW)
    registry_store.append(known, path, digits=1)
    assert sorted(registry_store.read(spark, path).drop("prefix").collect()) == sorted(known.collect())
    batch = prints(spark, ("p7.png", digest(7)), ("copy.png", digest(7)), ("new.png", digest(9999)), ("bad.png", None))
    near = registry_store.touched(spark, path, batch, digits=1)
    folders = {file.rsplit("/", 2)[-2] for file in near.inputFiles()}
    own = {digest(7)[0], digest(9999)[0]}
    assert "PartitionFilters: [prefix" in near._jdf.queryExecution().executedPlan().toString()
    assert {r["sha256"][0] for r in near.collect()} == own and len(folders) == 17 and near.count() < 120
    want = registry.register(batch, known, run_time=NOW)
    got = registry.register(batch, near, run_time=NOW)
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
    assert {r.source_path: r.status for r in got.collect()} == {"copy.png": "DUPLICATE_EXACT", "new.png": "INGESTED", "bad.png": "FAILED"}
    assert registry_store.touched(spark, path, prints(spark, ("x.png", None)), digits=1).count() == 0
