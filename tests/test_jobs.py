"""The jobs: two runs over growing input, batches run again, odd rows, command lines, and their queries' SQL."""

import hashlib
import json
import os
import subprocess
import sys
from collections import Counter

import duckdb
import pandas as pd
import pytest

from jobs import queries, release_manifest, storm_archive
from test_queries import SF, TABLES, _rows

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CONFIG = json.load(open(f"{HOME}/jobs/release_manifest.json"))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_job_query(spark, name):
    found = queries.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert len(found) and _rows(found) == _rows(con.execute(queries.ORACLE_SQL[name]).df())


def land(folder, name, rows):
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64", "n_chars": "Int64"})
    frame.to_parquet(f"{folder}/{name}.parquet")


def listed(spark, out):
    rows = spark.read.parquet(f"{out}/manifest").drop("batch", "feed").collect()
    return Counter((r.relpath, r.site, r.product, r.size_bytes, r.sha256) for r in rows)


def expected(rows):
    want = set()
    for i, text, lang, source, _ in rows:
        body, lang, source, i = (text or "").encode(), lang or "unknown", source or "unknown", "unknown" if i is None else i
        key = "".join(c if c.isascii() and c.isalnum() else "_" for c in source.lower())
        want.add((f"documents/{key}/{lang}/{i}.txt", source, lang, len(body), hashlib.sha256(body).hexdigest()))
    return want


def check_catalog(spark, out, rows):
    want = pd.DataFrame(sorted(expected(rows)), columns=["relpath", "site", "product", "size", "sha"]).groupby("site").agg(files=("sha", "size"), contents=("sha", "nunique"), total=("size", "sum"))
    got = {r.site: (r.files, r.contents, r.total_bytes) for r in spark.read.parquet(f"{out}/catalog").collect()}
    assert got == {site: tuple(v) for site, v in zip(want.index, want.to_numpy().tolist())}


FIRST = [(1, "one", "en", "Src A", 3), (2, "two é", "de", "Src A", 5), (3, None, None, None, 0), (4, "one", "en", "Src A", 3), (4, "one", "en", "Src A", 3)]
SECOND = [(1, "one", "en", "Src A", 3), (2, "two, changed", "de", "Src A", 5), (5, "", "en", "b", 0), (None, "no id", "en", "b", 5), (6, "one", "en", "Src A", 3)]


def test_manifest_takes_only_what_is_new(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    os.mkdir(source)
    land(source, "a", FIRST)
    run = lambda: release_manifest.run(spark, {"documents": source}, out, mark, CONFIG)
    assert run() == {"documents": 5}
    assert listed(spark, out) == Counter(expected(FIRST))
    land(source, "b", SECOND)
    assert run() == {"documents": 5}  # the second file's rows alone
    every = FIRST + SECOND
    assert listed(spark, out) == Counter(expected(every))
    check_catalog(spark, out, every)
    before = listed(spark, out)
    assert run() == {"documents": 0} and listed(spark, out) == before
    # a batch whose end was not noted is run again, and leaves the same rows
    for name in os.listdir(f"{mark}/documents/commits"):
        if name.lstrip(".").startswith("1"):
            os.remove(f"{mark}/documents/commits/{name}")
    assert run() == {"documents": 5} and listed(spark, out) == before
    check_catalog(spark, out, every)


def test_manifest_in_many_batches_and_of_an_empty_table(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    os.mkdir(source)
    every = []
    for k in range(4):
        rows = [(i, f"text {i % 7}", "en", f"s{i % 3}", 1) for i in range(k * 5, k * 5 + 8)]
        land(source, f"f{k}", rows)
        every += rows
    config = {**CONFIG, "files_per_trigger": 1}
    assert release_manifest.run(spark, {"documents": source}, out, mark, config) == {"documents": 32}
    assert spark.read.parquet(f"{out}/manifest").select("batch").distinct().count() == 4
    assert listed(spark, out) == Counter(expected(every))
    check_catalog(spark, out, every)
    os.mkdir(f"{source}-none")
    land(f"{source}-none", "empty", [])
    assert release_manifest.run(spark, {"documents": f"{source}-none"}, f"{out}-none", f"{mark}-none", config) == {"documents": 0}
    assert spark.read.schema(release_manifest.MANIFEST).parquet(f"{out}-none/manifest").count() == 0
    with pytest.raises(ValueError):
        release_manifest.run(spark, {"letters": source}, out, mark, config)


def files_of(folder):
    return sorted(os.path.relpath(d, folder) for d, _, names in os.walk(folder) if any(n.endswith(".parquet") for n in names))


def test_archive_again_is_the_same(spark, tmp_path):
    config = storm_archive.read_config(spark, f"{HOME}/jobs/storm_archive.json")
    at, out = [f"{SF}/{t}.parquet" for t in ("events", "supplier", "events", "events")], str(tmp_path / "out")
    seen = []
    for _ in range(2):
        storm_archive.run(spark, *at, out, config)
        seen.append({t: Counter(map(str, spark.read.parquet(f"{out}/{t}").collect())) for t in ("context", "observations", "catalog")})
    assert seen[0] == seen[1] and all(seen[0].values())
    context = spark.read.parquet(f"{out}/context")
    assert files_of(f"{out}/context") == sorted(f"year={r.year}/radar_site={r.radar_site}" for r in context.select("year", "radar_site").distinct().collect())
    found = spark.read.parquet(f"{out}/observations")
    assert context.agg({"n_reports": "sum"}).first()[0] == found.count() == spark.read.parquet(f"{out}/catalog").agg({"n_reports": "sum"}).first()[0] > 0
    # without the kept storms' tracks nothing of the run before is left
    few = str(tmp_path / "few.parquet")
    spark.read.parquet(at[0]).where("user_id >= 5").write.parquet(few)
    storm_archive.run(spark, few, at[1], at[2], at[3], out, config)
    assert files_of(f"{out}/context") == files_of(f"{out}/observations") == [] and spark.read.parquet(f"{out}/catalog").count() == 0
    none = str(tmp_path / "none.parquet")
    spark.read.parquet(at[0]).where("false").write.parquet(none)
    storm_archive.run(spark, none, at[1], none, none, str(tmp_path / "nothing"), config)


@pytest.mark.parametrize("job", ["release_manifest", "storm_archive"])
def test_command_line(tmp_path, job):
    out = str(tmp_path / "out")
    call = [sys.executable, f"{HOME}/jobs/{job}.py", "--config", f"{HOME}/jobs/{job}.json", "--output", out]
    if job == "release_manifest":
        call += ["--checkpoint", str(tmp_path / "mark"), "--input", f"documents={SF}/documents.parquet", "--input", f"pages={SF}/pages.parquet"]
    else:
        call += ["--tracks", f"{SF}/events.parquet", "--sites", f"{SF}/supplier.parquet", "--volumes", f"{SF}/events.parquet", "--reports", f"{SF}/events.parquet"]
    done = subprocess.run(call, capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert done.returncode == 0, done.stderr[-2000:]
    assert f"{out}/catalog" in done.stderr
    assert files_of(f"{out}/catalog")


def test_archive_leaves_only_its_output(spark, tmp_path, monkeypatch):
    """A run leaves no intermediate table, and writes no observation twice."""
    from cumulo import session
    from cumulo.sources import outputs

    shared, wrote = str(tmp_path / "shared"), []
    monkeypatch.setattr(session, "shared_folder", lambda _: f"file://{shared}")
    monkeypatch.setattr(outputs, "cut_lineage", lambda df, label: wrote.append(df.columns) or session.cut_lineage(df, label))
    config = storm_archive.read_config(spark, f"{HOME}/jobs/storm_archive.json")
    storm_archive.run(spark, *[f"{SF}/{t}.parquet" for t in ("events", "supplier", "events", "events")], str(tmp_path / "out"), config)
    assert files_of(shared) == [] and not any("obs_distance" in columns for columns in wrote)


def test_busy_sites_observations_are_dealt(spark, tmp_path, monkeypatch):
    config, at = storm_archive.read_config(spark, f"{HOME}/jobs/storm_archive.json"), [f"{SF}/{t}.parquet" for t in ("events", "supplier", "events", "events")]
    storm_archive.run(spark, *at, str(tmp_path / "a"), config)
    monkeypatch.setattr(storm_archive, "OBSERVED_POINTS", 2)
    monkeypatch.setattr(storm_archive, "CONTEXT_POINTS", 2)
    storm_archive.run(spark, *at, str(tmp_path / "b"), config)
    rows = lambda run, t: Counter(map(str, spark.read.parquet(f"{tmp_path}/{run}/{t}").collect()))
    assert all(rows("a", t) == rows("b", t) for t in ("context", "observations", "catalog"))
