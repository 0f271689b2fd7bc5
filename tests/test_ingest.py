"""Ingest: a fixed number of jobs, and quarantine of files and rows."""

import bz2
import gzip

import pytest

from flowforge.sources import flows_csv as SRC


def jobs_of(spark, name, run):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(name))


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    paths = [write(tmp_path / f"f{i}.csv", f" a ,b\n{i},x\n{i + 1},é\n", "latin-1" if i % 9 == 0 else "utf-8")
             for i in range(500)]
    few, few_jobs = jobs_of(spark, "few", lambda: SRC.read_flows(spark, paths[:40]).count())
    many, many_jobs = jobs_of(spark, "many", lambda: SRC.read_flows(spark, paths).count())
    assert (few, many) == (80, 1000) and many_jobs <= few_jobs + 1
    assert SRC.read_flows(spark, paths).where("b = 'é'").count() == 500
    inv, inv_jobs = jobs_of(spark, "inv", lambda: SRC.source_inventory(spark, paths + ["/none/x.csv"]).collect())
    assert inv_jobs <= many_jobs + 3 and sum(r["rows"] or 0 for r in inv) == 1000
    assert [r["path"] for r in inv if not r["present"]] == ["/none/x.csv"]


def test_quarantine(spark, tmp_path):
    good = gzip.compress(("a,b\n" + "".join(f"{i},t{i}\n" for i in range(5000))).encode())
    (tmp_path / "good.csv.gz").write_bytes(good)
    (tmp_path / "cut.csv.gz").write_bytes(good[:len(good) // 2])
    (tmp_path / "flipped.csv.gz").write_bytes(good[:200] + bytes([good[200] ^ 255]) + good[201:])
    (tmp_path / "cut.csv.bz2").write_bytes(bz2.compress(b"a,b\n1,2\n" * 1000)[:-9])
    write(tmp_path / "rows.csv", "a,b\n7000,x\n7001\n7002,y,z\n\n7003,\"q,r\"\n")
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "head only é.csv", "a,b\n")
    names = ["good.csv.gz", "cut.csv.gz", "flipped.csv.gz", "cut.csv.bz2", "rows.csv", "empty.csv", "head only é.csv", "none.csv"]
    flows, rejects = SRC.read_flows_checked(spark, [str(tmp_path / n) for n in names])
    assert flows.columns == ["a", "b"] and dict(flows.dtypes)["a"] == "bigint"
    rows = flows.where("a >= 7000").orderBy("a").collect()
    assert flows.count() == 5002 and [tuple(r) for r in rows] == [(7000, "x"), (7003, "q,r")]
    got = {(r["path"].rsplit("/", 1)[-1], r["reason"], r["record"]) for r in rejects.collect()}
    assert got == {("cut.csv.gz", "damaged", None), ("flipped.csv.gz", "damaged", None), ("cut.csv.bz2", "damaged", None),
                   ("empty.csv", "empty", None), ("none.csv", "missing", None),
                   ("rows.csv", "columns", "7001"), ("rows.csv", "columns", "7002,y,z")}
    inv = {r["path"].rsplit("/", 1)[-1]: (r["present"], r["rows"]) for r in
           SRC.source_inventory(spark, [str(tmp_path / n) for n in names]).collect()}
    assert inv["head only é.csv"] == (True, 0) and inv["cut.csv.gz"] == (False, None) and inv["good.csv.gz"] == (True, 5000)
    with pytest.raises(FileNotFoundError):
        SRC.read_flows_checked(spark, [str(tmp_path / "cut.csv.gz"), str(tmp_path / "none.csv")])


def test_folders_patterns_and_intact(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"p{i}.csv", f"a\n{i}\n")
    assert SRC.read_flows(spark, [str(tmp_path)]).count() == 3
    assert SRC.read_flows(spark, [str(tmp_path / "p[01].csv")]).count() == 2
    two = gzip.compress(b"x" * 9_000_000) + gzip.compress(b"y")
    assert SRC.intact(two, "a.gz") and not SRC.intact(two[:-3], "a.gz") and not SRC.intact(b"junk", "a.gz")
    assert SRC.intact(bz2.compress(b"x" * 9_000_000), "a.bz2")


def test_packed_files_follow_the_rows(spark, monkeypatch):
    """A packed file cannot be cut between tasks: more rows are more files."""
    from flowforge.plans import q_io
    seen = []
    read = q_io.SRC.read_flows_checked
    monkeypatch.setattr(q_io.SRC, "read_flows_checked", lambda s, paths: seen.append(paths) or read(s, paths))
    monkeypatch.setattr(q_io, "PACKED_ROWS", 200)
    rows = {r["result"]: r["n"] for r in q_io.q_skip_bad_file(spark, "/root/testdata/sf0.001").collect()}
    assert sum(p.endswith(".csv.gz") for p in seen[0]) - 1 == -(-rows["kept"] // 200) > 4
