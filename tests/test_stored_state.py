"""Malformed cells, stored state across runs, the bucket layout and its recovery."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import local, write_files
from test_payloads import AV_OK, HEADER

from qtrbars.operators import universe as U
from qtrbars.operators.returns import trading_span
from qtrbars.plans import pipelines as P
from qtrbars.session import shared_dir
from qtrbars.sinks import parquet as SK
from qtrbars.streaming import ingest as ING

LOAD = "2024-01-01 00:00:00"
PAYLOADS = "source string, ticker string, path string, modified timestamp, payload string"


def _classified(spark, vendor, texts):
    df = spark.createDataFrame([(vendor, t, None, None, p) for t, p in texts.items()], PAYLOADS)
    out = P.process_payloads(df, vendor)
    return out, {r.ticker: r.status for r in out["classified"].collect()}


def test_av_malformed_cells(spark):
    line = "2024-01-02,{o},2,0.5,1.5,1.5,{v},0,1\n"
    out, got = _classified(spark, "AV", {
        "WORD": HEADER + line.format(o="abc", v=10),
        "BIG": HEADER + line.format(o=1, v="1e25"),
        "EDGE": HEADER + line.format(o=1, v=2**63),
        "MAX": HEADER + line.format(o=1, v=2**63 - 1),
        "COMMA": HEADER + line.format(o='"1,234"', v=10),
        "QUOTED": HEADER + line.format(o='"1.25"', v='"10"'),
        "GAP": HEADER + line.format(o="", v="null"),
        "SUM": HEADER + line.format(o=1, v=9 * 10**18) * 2,
    })
    assert got == {"WORD": "unparseable", "BIG": "unparseable", "EDGE": "unparseable", "MAX": "ok",
                   "COMMA": "unparseable", "QUOTED": "ok", "GAP": "ok", "SUM": "unparseable"}
    bars = {r.ticker: (r.open, r.volume) for r in out["bars"].collect()}
    assert bars == {"QUOTED": (1.25, 10), "GAP": (None, 0), "MAX": (1.0, 2**63 - 1)}


def test_quoted_records_go_over_lines(spark):
    line = '"first, ""quoted""\n\r\nlast",2024-01-0{d},1,2,0.5,1.5,"{p}",10,0,1\n'
    wide = "note," + HEADER
    out, got = _classified(spark, "AV", {
        "NOTES": wide + line.format(d=2, p="1.25") + "\n" + line.format(d=3, p=" 1.75 "),
        "EMPTY": wide + '"",2024-01-02,1,2,0.5,1.5,"",10,0,1',
        "OPEN": wide + '"never closed,2024-01-02,1,2,0.5,1.5,1,10,0,1\n' + line.format(d=3, p="1"),
        "BROKEN": wide + line.format(d=2, p="1\n5"),
        "SHIELD": wide + line.format(d=2, p="\ue000").replace("last", "\ue001,\ue002"),
        "HEADER": '"no\nte",' + HEADER + line.format(d=2, p="2"),
    })
    assert got == {"NOTES": "ok", "EMPTY": "ok", "OPEN": "unparseable", "BROKEN": "unparseable", "SHIELD": "unparseable",
                   "HEADER": "ok"}
    bars = {r.ticker: (r.open, r.adjusted_close, r.volume) for r in out["bars"].collect()}
    assert bars == {"NOTES": (1.0, 1.75, 20), "EMPTY": (1.0, None, 10), "HEADER": (1.0, 2.0, 10)}


def test_a_long_quoted_record_is_read_in_linear_time(spark):
    import time
    from qtrbars.functions import payload as PL

    def seconds(n):
        text = "note," + HEADER + '"a,b""\n",2024-01-02,1,2,0.5,1.5,1,10,0,1\n' * n
        df = PL.with_av_parse(spark.createDataFrame([(text,)], "payload string"))
        began = time.time()
        assert [tuple(r) for r in df.select("status", F.size("rows")).collect()] == [("ok", n)]
        return time.time() - began
    seconds(100)
    few, many = seconds(4_000), seconds(64_000)
    assert many < 30 * max(few, 0.25)  # 16 times the records; quadratic would be 256


def test_fmp_malformed_values(spark):
    rec = '{{"symbol":"X","historical":[{{"date":"2024-01-02","open":{o},"close":{c},"volume":{v}}}]}}'
    out, got = _classified(spark, "FMP", {
        "WORD": rec.format(o='"abc"', c=1, v=1), "TEXT": rec.format(o='"1.5"', c='"2.5"', v=9007199254740993),
        "NULL": rec.format(o="null", c=2, v=1), "BIG": rec.format(o=1, c=1, v=10**25)})
    assert got == {"WORD": "unparseable", "TEXT": "ok", "NULL": "ok", "BIG": "unparseable"}
    text = out["bars"].where("ticker = 'TEXT'").first()
    assert (text.open, text.close, text.volume) == (1.5, 2.5, 9007199254740993)


def _ingest(spark, base, rows):
    df = spark.createDataFrame([(t, dt.datetime(2024, m, 1), i, p) for t, m, i, p in rows], ING.LANDING_SCHEMA)
    ING.land(df, f"{base}/landing")
    ING.run_ingest(spark, f"{base}/landing", "AV", f"{base}/bars", f"{base}/na", f"{base}/q", f"{base}/ckpt",
                   data_load=LOAD, manifest_path=f"{base}/man")

    def tickers(name, schema):
        path = f"{base}/{name}"
        return {r.ticker for r in SK.read_bucketed(spark, path, schema).collect()}
    return (tickers("bars", SK.BAR_SCHEMA), tickers("q", SK.RECORD_SCHEMA), tickers("na", SK.RECORD_SCHEMA),
            tickers("man", SK.MANIFEST_SCHEMA))


def test_newest_answer_decides_where_a_ticker_stands(spark, scratch):
    unknown = '{\n    "Error Message": "Invalid API call."\n}\n'
    limited = '{"message":"You have exceeded the DAILY quota for this API key"}'
    assert _ingest(spark, scratch, [("AAA", 3, 1, HEADER), ("BBB", 3, 2, AV_OK), ("CCC", 3, 3, unknown)]) == (
        {"BBB"}, {"AAA"}, {"CCC"}, {"BBB"})
    # older answers arrive late: nothing changes
    assert _ingest(spark, scratch, [("AAA", 2, 4, AV_OK), ("BBB", 2, 5, HEADER)]) == (
        {"BBB"}, {"AAA"}, {"CCC"}, {"BBB"})
    # newer ones: AAA and CCC become usable, BBB is no longer known
    assert _ingest(spark, scratch, [("AAA", 4, 6, AV_OK), ("BBB", 4, 7, unknown), ("CCC", 4, 8, AV_OK)]) == (
        {"AAA", "CCC"}, set(), {"BBB"}, {"AAA", "CCC"})
    # a rate limit is no answer
    assert _ingest(spark, scratch, [("AAA", 5, 9, limited)]) == ({"AAA", "CCC"}, set(), {"BBB"}, {"AAA", "CCC"})


def test_rate_limit_never_hides_an_answer(spark, scratch):
    limited = '{"message":"You have exceeded the DAILY quota for this API key"}'
    # a good answer and a later rate limit picked up together; a rate limit alone
    assert _ingest(spark, scratch, [("AAA", 3, 1, AV_OK), ("AAA", 4, 2, limited), ("BBB", 4, 3, limited)]) == (
        {"AAA"}, set(), set(), {"AAA"})
    # answers fetched before those rate limits arrive late: they are the newest answers
    assert _ingest(spark, scratch, [("BBB", 2, 4, AV_OK), ("AAA", 3, 5, HEADER)]) == (
        {"BBB"}, {"AAA"}, set(), {"BBB"})
    # older than the newest answer
    assert _ingest(spark, scratch, [("BBB", 1, 6, HEADER), ("AAA", 2, 7, AV_OK)]) == ({"BBB"}, {"AAA"}, set(), {"BBB"})


def test_batch_reader_takes_the_newest_answer(spark, scratch):
    limited = '{"message":"You have exceeded the DAILY quota for this API key"}'
    folder = local(write_files(scratch, {"AAA_AV_1.csv": AV_OK, "AAA_AV_2.csv": limited, "BBB_AV_1.csv": limited}))
    for k, name in enumerate(("AAA_AV_1.csv", "AAA_AV_2.csv", "BBB_AV_1.csv")):
        os.utime(f"{folder}/{name}", (1_700_000_000 + k, 1_700_000_000 + k))
    out = P.av_quarterly(spark, scratch, data_load=LOAD)
    assert {r.ticker for r in out["bars"].collect()} == {"AAA"}
    assert [r.ticker for r in out["retry"].collect()] == ["BBB"]


def _spans(spark, source, n, quarter="2024Q1"):
    return spark.range(n).select(F.lit(quarter).alias("first_quarter"), F.lit(quarter).alias("last_quarter"),
                                 F.lit(source).alias("source"), U.ticker_col("T", "id").alias("ticker"))


def _read(spark, path, **kw):
    return {(r.source, r.ticker, r.last_quarter)
            for r in SK.read_bucketed(spark, path, SK.MANIFEST_SCHEMA, **kw).collect()}


def test_bucket_count_and_filters(spark, scratch):
    path = f"{scratch}/t"
    write = lambda df, **kw: SK.replace_in_buckets(df, path, SK.MANIFEST_SCHEMA, order=(), **kw)
    write(_spans(spark, "A", 100), n_buckets=8)
    write(_spans(spark, "B", 100))
    assert SK.stored_buckets(spark, path) == 8
    with pytest.raises(ValueError):
        write(_spans(spark, "A", 1), n_buckets=16)
    assert len(_read(spark, path)) == 200 and len(_read(spark, path, source="A")) == 100
    assert _read(spark, path, tickers=[]) == set() == _read(spark, path, source="A", tickers=[])
    assert {s for s, _, _ in _read(spark, path, tickers=["T5"])} == {"A", "B"}
    some = [f"T{i}" for i in range(0, 100, 10)]
    assert {t for _, t, _ in _read(spark, path, source="B", tickers=some)} == set(some)
    one = SK.read_bucketed(spark, path, SK.MANIFEST_SCHEMA, tickers=["T5"], source="A")
    assert len({f.rsplit("/", 1)[0] for f in one.inputFiles()}) == 1  # one bucket's folder
    assert {t for _, t, _ in _read(spark, path, tickers=spark.createDataFrame([("T5",), ("T5",)], "ticker string"))} == {"T5"}
    # an empty write changes nothing, retiring all of a source empties it
    write(_spans(spark, "A", 0))
    write(_spans(spark, "A", 0), retire=_spans(spark, "A", 100))
    assert {s for s, _, _ in _read(spark, path)} == {"B"} and len(_read(spark, path)) == 100


def _files(spark, path):
    """Data file -> (time, bytes) of everything below a table's folder."""
    root = local(path)
    return {os.path.join(d, f): (os.stat(os.path.join(d, f)).st_mtime_ns, os.stat(os.path.join(d, f)).st_size)
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_replacing_writes_touched_buckets_only(spark, scratch):
    path = f"{scratch}/t"
    first = SK.replace_in_buckets(_spans(spark, "A", 50), path, SK.MANIFEST_SCHEMA, 8, ())
    before = _files(spark, path)
    second = SK.replace_in_buckets(_spans(spark, "A", 1, "2024Q2"), path, SK.MANIFEST_SCHEMA, order=())
    assert (first.number, second.number) == (0, 1)
    changed = set(first.places().items()) - set(second.places().items())
    assert len(changed) == 1 and set(first.places()) == set(second.places())
    assert {f: s for f, s in _files(spark, path).items() if f in before} == before
    assert sum(q == "2024Q2" for _, _, q in _read(spark, path)) == 1 and len(_read(spark, path)) == 50


def test_odd_source_names(spark, scratch):
    path, names = f"{scratch}/t", ["A/B", "x=*{y}", "50% [ü] #1", "plain"]
    for name in names:
        SK.replace_in_buckets(_spans(spark, name, 5), path, SK.MANIFEST_SCHEMA, 4 if name == "A/B" else None, ())
    SK.replace_in_buckets(_spans(spark, "x=*{y}", 2, "2024Q2"), path, SK.MANIFEST_SCHEMA, order=())
    got = _read(spark, path)
    assert len(got) == 20 and {s for s, _, _ in got} == set(names)
    assert sorted(q for _, _, q in _read(spark, path, source="x=*{y}")) == ["2024Q1"] * 3 + ["2024Q2"] * 2
    assert {t for _, t, _ in _read(spark, path, source="A/B", tickers=["T3"])} == {"T3"}


def test_pinned_reader_sees_one_version(spark, scratch):
    path = f"{scratch}/t"
    SK.replace_in_buckets(_spans(spark, "A", 40), path, SK.MANIFEST_SCHEMA, 4, ())
    pinned = SK.read_bucketed(spark, path, SK.MANIFEST_SCHEMA)
    SK.replace_in_buckets(_spans(spark, "A", 20, "2024Q2"), path, SK.MANIFEST_SCHEMA, order=())
    SK.replace_in_buckets(_spans(spark, "A", 0), path, SK.MANIFEST_SCHEMA, order=(), retire=_spans(spark, "A", 40))
    assert {r.last_quarter for r in pinned.collect()} == {"2024Q1"} and pinned.count() == 40
    assert SK.read_bucketed(spark, path, SK.MANIFEST_SCHEMA).count() == 0
    middle = SK.read_bucketed(spark, path, SK.MANIFEST_SCHEMA, at=SK.version(spark, path, 1))
    assert sorted(r.last_quarter for r in middle.collect()) == ["2024Q1"] * 20 + ["2024Q2"] * 20
    assert SK.versions(spark, path) == [0, 1, 2]
    # none of the three commits holds a row of the version kept
    assert SK.vacuum(spark, path, keep=1) == 3 and SK.versions(spark, path) == [2]
    assert SK.read_bucketed(spark, path, SK.MANIFEST_SCHEMA).count() == 0


def test_second_writer_on_a_version_raises(spark, scratch):
    path = f"{scratch}/t"
    SK.replace_in_buckets(_spans(spark, "A", 30), path, SK.MANIFEST_SCHEMA, 4, ())
    one = SK.stage_replace(_spans(spark, "A", 10, "2024Q2"), path, SK.MANIFEST_SCHEMA, order=())
    other = SK.stage_replace(_spans(spark, "B", 10), path, SK.MANIFEST_SCHEMA, order=())
    SK.publish_version(spark, one)
    with pytest.raises(SK.ConcurrentWrite):
        SK.publish_version(spark, other)
    got = _read(spark, path)
    assert len(got) == 30 and sum(q == "2024Q2" for _, _, q in got) == 10
    SK.replace_in_buckets(_spans(spark, "B", 10), path, SK.MANIFEST_SCHEMA, order=())  # starting over works
    assert len(_read(spark, path)) == 40
    assert SK.vacuum(spark, path, keep=1) > 0 and len(_read(spark, path)) == 40


def test_writer_that_dies_before_publishing_changes_nothing(spark, scratch):
    path = f"{scratch}/t"
    SK.replace_in_buckets(_spans(spark, "A", 60), path, SK.MANIFEST_SCHEMA, 4, ())
    SK.stage_replace(_spans(spark, "A", 20, "2024Q2"), path, SK.MANIFEST_SCHEMA, order=())  # never published
    assert {q for _, _, q in _read(spark, path)} == {"2024Q1"}
    SK.replace_in_buckets(_spans(spark, "A", 20, "2024Q3"), path, SK.MANIFEST_SCHEMA, order=())
    assert SK.vacuum(spark, path, keep=2) == 1  # what it left
    got = _read(spark, path)
    assert len(got) == 60 and sum(q == "2024Q3" for _, _, q in got) == 20


def test_large_buckets_are_cut_between_tickers(spark, scratch):
    path = f"{scratch}/t"
    rows = spark.range(600).select(F.concat(F.lit("2"), F.format_string("%03d", F.col("id") % 50), F.lit("Q1")).alias("first_quarter"),
                                   F.lit("x").alias("last_quarter"), F.lit("A").alias("source"),
                                   U.ticker_col("T", F.floor(F.col("id") / 50)).alias("ticker"))
    SK.replace_in_buckets(rows, path, SK.MANIFEST_SCHEMA, 2, ("first_quarter",), rows_per_file=100)
    assert len(_files(spark, path)) > 2
    stored = SK.read_bucketed(spark, path, SK.MANIFEST_SCHEMA).withColumn("file", F.input_file_name()).collect()
    files = {}
    for r in stored:  # in stored order within a file
        files.setdefault(r.file, []).append((r.ticker, r.first_quarter))
    of = {t: {f for f, rs in files.items() if any(x == t for x, _ in rs)} for t, _ in sum(files.values(), [])}
    assert len(of) == 12 and all(len(v) == 1 for v in of.values())
    for rs in files.values():
        by = {}
        for t, q in rs:
            by.setdefault(t, []).append(q)
        assert list(by) == sorted(by) and all(q == sorted(q, reverse=True) for q in by.values())


def test_same_answer_again_touches_no_bucket(spark, scratch):
    rows = [("AAA", 3, 1, AV_OK), ("BBB", 3, 2, HEADER), ("CCC", 3, 3, AV_OK)]
    assert _ingest(spark, scratch, rows) == ({"AAA", "CCC"}, {"BBB"}, set(), {"AAA", "CCC"})
    tables = ("bars", "q", "man")
    before = {t: _files(spark, f"{scratch}/{t}") for t in tables}
    index = _files(spark, f"{scratch}/bars_index")
    _ingest(spark, scratch, rows)  # the same fetches landed once more: nothing at all
    assert {t: _files(spark, f"{scratch}/{t}") for t in tables} == before
    assert _files(spark, f"{scratch}/bars_index") == index
    # fetched again later, same text: the index alone learns of the newer fetch
    _ingest(spark, scratch, [(t, 5, i + 10, p) for t, _, i, p in rows])
    assert {t: _files(spark, f"{scratch}/{t}") for t in tables} == before
    months = {r.ticker: (r.state, r.modified.month) for r in SK.read_bucketed(spark, f"{scratch}/bars_index", SK.INDEX_SCHEMA).collect()}
    assert months == {"AAA": ("bars", 5), "BBB": ("quarantine", 5), "CCC": ("bars", 5)}
    # a different older answer that arrives late is older than the refetch
    assert _ingest(spark, scratch, [("AAA", 4, 20, HEADER)]) == ({"AAA", "CCC"}, {"BBB"}, set(), {"AAA", "CCC"})
    # a newer one with another text moves the ticker
    assert _ingest(spark, scratch, [("AAA", 6, 21, HEADER)]) == ({"CCC"}, {"AAA", "BBB"}, set(), {"CCC"})


def test_a_fetch_landed_twice_counts_once(spark, scratch):
    _ingest(spark, scratch, [("AAA", 3, 1, AV_OK), ("AAA", 3, 1, AV_OK), ("BBB", 3, 2, AV_OK)])
    bars = SK.read_bucketed(spark, f"{scratch}/bars").collect()
    assert sorted((r.ticker, r.quarter, r.volume) for r in bars) == [
        ("AAA", "2024Q1", 400), ("AAA", "2024Q2", 300), ("BBB", "2024Q1", 400), ("BBB", "2024Q2", 300)]


def test_pending_work_reads_the_index_alone(spark, scratch):
    unknown = '{\n    "Error Message": "Invalid API call."\n}\n'
    _ingest(spark, scratch, [("AAA", 3, 1, AV_OK), ("BBB", 3, 2, HEADER), ("CCC", 3, 3, unknown)])
    universe = spark.createDataFrame([(t,) for t in ("AAA", "BBB", "CCC", "NEW", "NEW", None)], "ticker string")
    pending = P.pending_work(spark, universe, f"{scratch}/bars", "AV")
    assert sorted(r.ticker for r in pending.collect()) == ["BBB", "NEW"]
    files = pending.inputFiles()
    assert files and all("/bars_index/" in f for f in files)
    assert sorted(r.ticker for r in P.pending_work(spark, universe, f"{scratch}/bars", "FMP").collect()) == ["AAA", "BBB", "CCC", "NEW"]


def test_frequent_symbol_spreads(spark):
    df = spark.range(20_000).select(F.col("id").alias("cusip"), F.when(F.col("id") % 2 == 0, "BRK.B").otherwise(
        F.concat(F.lit("S"), F.col("id").cast("string"))).alias("ticker"))
    order = [F.col("ticker"), F.xxhash64(*df.columns)]
    sizes = [r["count"] for r in df.repartitionByRange(4, *order).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 20_000 / 4
    idx = U.with_global_index(df, ["ticker"], partitions=4)
    got = [(r.row_index, r.ticker) for r in idx.collect()]
    assert sorted(i for i, _ in got) == list(range(20_000))
    assert [t for _, t in sorted(got)] == sorted(t for _, t in got)


def test_shared_folder_is_required_off_local():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(_key, default=None):
                return default
    with pytest.raises(RuntimeError):
        shared_dir(Session())


def test_span_is_a_hash_aggregate(spark):
    bars = spark.createDataFrame([("A", "2024Q1", 1.0), ("A", "1999Q4", None), ("A", "2000Q3", 2.0), ("B", "2024Q1", None)],
                                 "ticker string, quarter string, adjusted_close double")
    span = trading_span(bars)
    assert "SortAggregate" not in span._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in span.collect()} == {("A", "2000Q3", "2024Q1"), ("B", None, None)}


def test_a_refetch_of_the_same_texts_reads_no_payload_again(spark, scratch, monkeypatch):
    plans = []

    def spy(payloads, *args, **kwargs):
        plans.append(payloads._jdf.queryExecution().optimizedPlan().toString())
        return P.process_payloads(payloads, *args, **kwargs)
    monkeypatch.setattr(ING, "process_payloads", spy)
    first = _ingest(spark, scratch, [("AAA", 1, 1, AV_OK), ("BBB", 1, 2, HEADER)])
    assert _ingest(spark, scratch, [("AAA", 2, 3, AV_OK), ("BBB", 2, 4, HEADER)]) == first
    assert len(plans) == 2 and "Join" in plans[0]
    assert "Join" not in plans[1] and "RDD" not in plans[1] and "LocalRelation <empty>" in plans[1]
    index = SK.read_bucketed(spark, P.index_path(f"{scratch}/bars"), SK.INDEX_SCHEMA).collect()
    assert {(r.ticker, r.fetch_id, r.modified.month) for r in index} == {("AAA", 3, 2), ("BBB", 4, 2)}
    # one changed text among refetches
    assert _ingest(spark, scratch, [("AAA", 3, 5, AV_OK), ("BBB", 3, 6, AV_OK)])[:2] == ({"AAA", "BBB"}, set())


@pytest.mark.parametrize("way, broadcast, hashed", [("Broadcast", 100, 0), ("ShuffledHashJoin", 0, 100), ("SortMergeJoin", 0, 0)])
def test_the_newest_payload_is_found_whichever_way_it_is_joined(spark, monkeypatch, way, broadcast, hashed):
    import hashlib
    day, limited = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)], "You have exceeded the DAILY quota"
    rows = [  # ticker, modified, fetch_id, path, payload
        ("LAST", day[1], 1, "a", "old"), ("LAST", day[2], 2, "a", "new"), ("LAST", day[2], 2, "a", "new"),
        ("TEXT", day[1], 1, "a", "one"), ("TEXT", day[1], 1, "a", "two"), ("PATH", day[1], None, "b", "x"),
        ("PATH", day[1], None, "c", "y"), ("PATH", day[1], None, None, "z"), ("IDS", day[1], None, None, "x"),
        ("IDS", day[1], -1, None, "y"), ("IDS", day[1], -7, "z", "z"), ("FILE", day[1], 3, "b", "x"), ("FILE", day[1], 3, "a", "y"),
        ("LIMIT", day[1], 1, "a", "answer"), ("LIMIT", day[2], 2, "a", limited), ("ONLY", day[1], 1, "a", limited),
        ("NONE", None, 9, "a", "x"), ("NONE", day[1], 1, "a", None), (None, day[1], 1, "a", "x"), (None, day[2], 1, "a", "y")]

    def low(v):  # null is the least
        return (v is not None, v or 0) if isinstance(v, int) or v is None else (True, v)

    def head(r):
        _, modified, fetch, path, text = r
        digest = "" if text is None else hashlib.sha256(text.encode()).hexdigest()
        return (text != limited, low(modified), -1 if fetch is None else fetch, (path or "") if fetch is None else "",
                fetch is not None, low(path), digest)
    newest = {}
    for r in rows:
        newest[r[0]] = max(newest.get(r[0], r), r, key=head)
    batch = spark.createDataFrame([("AV", *r) for r in rows], "source string, ticker string, modified timestamp, fetch_id long, "
                                  "path string, payload string")
    monkeypatch.setattr(ING, "BROADCAST_FETCHES", broadcast)
    monkeypatch.setattr(ING, "HASHED_FETCHES", hashed)
    decided = ING.decide(batch, "AV", spark.createDataFrame([], SK.INDEX_SCHEMA))
    assert {r.ticker: r.fetch_id for r in decided.collect()} == {t: r[2] for t, r in newest.items()}
    found = ING.wanted_payloads(batch, decided.where("changed"))
    got = found.select("ticker", "modified", "fetch_id", "path", "payload").collect()
    assert len(got) == len(newest) and {tuple(r) for r in got} == set(newest.values())
    plan = found._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line and "payload" not in line.split("Join")[0])
    assert way in join
    assert not any("hashpartitioning" in line and "sha2" in line for line in plan.splitlines())
