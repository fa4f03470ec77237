"""Running values carried from block to block, and the scans built on them, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from confluo.operators import carry, health
from confluo.scratch import folder
from confluo.sources import feeds, playlists


def playlist(n, seed=0):
    rng, out = random.Random(seed), ["#EXTM3U x"]
    for i in range(n):
        out.append(rng.choice([f'#EXTINF:-1 tvg-id="{i}",T {i}', f"#EXTINF:5,T {i}", f"http://h/{i}", f"#note {i}", f'#EXTINF:-1 a="b,{i}', "", f"http://h/{i}"]))
    return out


def plain(lines):
    entries, header, rejects, now = [], [], [], None
    for no, line in enumerate(lines, 1):
        if line.startswith("#EXTINF:"):
            now = [no, line, "", []]
            (rejects if '"b,' in line else entries).append(now)
        elif line.startswith("#"):
            (header if now is None else now[3]).append(line)
        elif line and now:
            now[2], now = line, None
    return [(e[0], e[1].split(",")[-1], e[2], e[3]) for e in entries], "\n".join(header), [(r[0], r[1]) for r in rejects]


def found(scanned):
    e, h, r = scanned
    key = lambda x: (x.line_no, x.title, x.url, list(x.directives))
    return sorted(map(key, e.collect())), h.first().header, sorted((x.line_no, x.line) for x in r.collect())


@pytest.mark.parametrize("block", [1, 7, 50_000])
def test_scan_in_blocks_of_any_size(spark, block):
    lines = playlist(400)
    assert found(playlists.scan(spark.createDataFrame([("f", "\r\n".join(lines))], "file string, value string"), block)) == plain(lines)


def test_one_file_of_a_million_lines(spark, tmp_path):
    lines = playlist(1_000_000, 1)
    (tmp_path / "big.m3u").write_text("\n".join(lines))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        ln = playlists.read_lines(spark, str(tmp_path))
        e, h, r = playlists.scan_lines(ln)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        want = plain(lines)
        got = e.agg(F.count("*"), F.sum(F.hash("title", "url", F.array_join("directives", "|")).cast("long")), F.sum("line_no")).first()
        table = spark.createDataFrame([(a, b, c, d) for a, b, c, d in want[0]], "line_no long, title string, url string, directives array<string>")
        assert got == table.agg(F.count("*"), F.sum(F.hash("title", "url", F.array_join("directives", "|")).cast("long")), F.sum("line_no")).first()
        assert h.first().header == want[1] and r.count() == len(want[2])
        # no window sees a whole file: what it is partitioned by names a block, or it runs over one row a block or byte range
        plan = e._jdf.queryExecution().optimizedPlan().toString()
        assert all("_block" in w or "_out_" in w or "start#" in w for w in plan.split("\n") if "Window [" in w)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_running_values(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([None, rng.randrange(9)])) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, x int").repartition(7)
    at = carry.blocks(df, ["g"], ["i"], 20)
    x = F.col("x")
    got = {r.i: (r.s, r.l, r.b, r.f) for r in carry.running(at, ["g"], "_block", "_n", {"s": ("sum", x), "l": ("last", x), "b": ("before", x), "f": ("first", x)}).collect()}
    state = {}
    for g, i, v in rows:
        s, last, first = state.get(g, (0, None, None))
        before = last
        if v is not None:
            s, last, first = s + v, v, v if first is None else first
        state[g] = (s, last, first)
        assert got[i] == (s, last, before, first)
    with pytest.raises(ValueError):
        carry.running(at, ["g"], "_block", "_n", {"s": ("mean", x)})


def test_failures_in_a_row(spark):
    rng = random.Random(4)
    rows = [("hot" if i % 3 else f"k{i % 9}", i, rng.random() < 0.3 if i % 50 else None) for i in range(600)]
    got = {r.t: r.failures for r in health.runs(spark.createDataFrame(rows, "id string, t int, ok boolean"), "id", ["t"], "ok", block=11).collect()}
    n = {}
    for k, t, ok in rows:
        n[k] = 0 if ok else n.get(k, 0) + (ok is False)
        assert got[t] == n[k]


def test_guide_in_blocks(spark):
    lines = []
    for s in range(40):
        lines.append(f"Section {s} (3 channels)")
        lines += [f"{i}. # Sub {i} #" if (i + s) % 4 == 0 else f"{i}. Name {s}-{i}" for i in range(1, 9)] + [""]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, pos int, line string").repartition(5)
    whole = [(r.section, r.subsection, r.name) for r in feeds.parse_guide(df).orderBy("pos").collect()]
    assert whole == [(r.section, r.subsection, r.name) for r in feeds.parse_guide(df, 3).orderBy("pos").collect()] and len(whole) == 240
    assert whole[0] == ("Section 0", "", "Name 0-1") and whole[3] == ("Section 0", "sub 4", "Name 0-5")


def test_lines_of_several_files_are_numbered(spark):
    path = folder(spark)
    spark.range(3).selectExpr("concat('a', id)").coalesce(1).write.text(path)
    spark.range(4).selectExpr("concat('b', id)").coalesce(1).write.mode("append").text(path)
    got = playlists.read_lines(spark, path).orderBy("file", "pos").collect()
    assert sorted((r.pos, r.line) for r in got) == sorted([(i, f"a{i}") for i in range(3)] + [(i, f"b{i}") for i in range(4)])
