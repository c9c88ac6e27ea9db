"""Filters, queue order, documents, index tables, harvest state, text and plans."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from model import at, make_job
from shelfmark import schemas
from shelfmark.functions import ids, text
from shelfmark.functions.times import ntz
from shelfmark.operators import debounce as db
from shelfmark.operators import documents as docs
from shelfmark.operators import filters, harvest, index_tables
from shelfmark.operators.apply import count_after
from shelfmark.operators.jobs import fan_out, fan_out_counted
from shelfmark.operators.postings import build_postings, changed_terms, postings_change
from shelfmark.operators.skew import measure, salted_lookup
from shelfmark.session import materialize, scratch_dir

NOW = dt.datetime(2014, 6, 9, 17, 30)


def frame(spark, *jobs):
    rows = [make_job(*j) for j in jobs]
    return spark.createDataFrame([tuple(r[c] for c in schemas.JOB_COLUMNS) for r in rows], schemas.JOBS)


def column(df, name):
    return sorted(r[name].number if name == "seq" else r[name] for r in df.collect())


# Filters


def passing(spark, predicate, *jobs):
    return column(filters.filter_jobs(frame(spark, *jobs), predicate), "seq")


def test_match_pid_matches_the_whole_pid(spark):
    jobs = [("object", "CREATE", p, "", at(0), 0, i) for i, p in enumerate(["test:1234", "NOOP:1234", "xtest:1", "test:1\n", "test:1x"])]
    assert passing(spark, filters.match_pid(r"^test:\d+$"), *jobs) == [0]
    assert passing(spark, filters.match_pid(r"a|test:1234"), *jobs) == [0]


def test_exclude_and_relevant_datastreams(spark):
    jobs = [
        ("object", "UPDATE", "t:1", "MODS", at(0), 0, 0), ("datastream", "UPDATE", "t:1", "DC", at(0), 0, 1),
        ("datastream", "UPDATE", "t:1", "ATT-1", at(0), 0, 2), ("object", "UPDATE", "t:1", "DC", at(0), 0, 3),
        ("object", "UPDATE", "t:1", "", at(0), 0, 4),
    ]
    assert passing(spark, filters.exclude_datastreams(["DC", "RELS-EXT", "MODS"]), *jobs) == [0, 2, 3, 4]
    assert passing(spark, filters.relevant_datastreams(["MODS"]), *jobs) == [0, 1, 2, 4]


def test_predicates_all_have_to_hold(spark):
    jobs = frame(spark, *[("object", "CREATE", f"t:{i}", "", at(0), 0, i) for i in range(6)])
    even, high = (lambda: F.col("seq.number") % 2 == 0), (lambda: F.col("seq.number") > 2)
    assert filters.filter_jobs(jobs).count() == 6
    assert column(filters.filter_jobs(jobs, even, high), "seq") == [4]
    assert filters.filter_jobs(jobs, lambda: F.lit(False)).count() == 0


def test_filter_runs_below_the_shuffle(spark):
    path = scratch_dir(spark, "jobs")
    frame(spark, ("datastream", "CREATE", "t:1", "DC", at(0), 1, 1)).write.parquet(path)
    jobs = spark.read.parquet(path)
    plan = db.debounce(filters.filter_jobs(jobs, filters.exclude_datastreams(["DC"])))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange"):]
    assert "kind" in below[below.index("Filter"):].split("\n")[0]


# Queue


def test_equal_jobs_count_once_and_the_last_wins(spark):
    jobs = frame(
        spark, ("object", "UPDATE", "t:1", "", at(0), 5, 1), ("object", "UPDATE", "t:1", "", at(2), 5, 2),
        ("object", "DELETE", "t:1", "", at(2), 0, 3), ("object", "UPDATE", "t:2", "", at(0), 5, 4),
    )
    assert column(db.keep_latest(jobs), "seq") == [2, 3, 4]
    assert column(db.debounce(jobs), "seq") == [2, 3, 4]


def test_an_equal_job_at_ready_time_comes_too_late(spark):
    jobs = frame(spark, ("object", "CREATE", "t:1", "", at(0), 1, 1), ("object", "CREATE", "t:1", "", at(1), 1, 2))
    assert column(db.debounce(jobs), "seq") == [1, 2]
    close = frame(spark, ("object", "CREATE", "t:1", "", at(0), 1, 1), ("object", "CREATE", "t:1", "", at(0.9), 1, 2))
    assert column(db.debounce(close), "seq") == [2]


def test_modes_differ_in_what_is_equal(spark):
    jobs = frame(spark, ("object", "UPDATE", "t:1", "A", at(0), 1, 1), ("datastream", "UPDATE", "t:1", "A", at(0), 5, 2))
    assert column(db.settle(jobs, "reference"), "seq") == [2]
    assert column(db.settle(jobs, "corrected"), "seq") == [1, 2]


def test_deletes_cancel_waiting_jobs_when_corrected(spark):
    jobs = frame(
        spark, ("object", "UPDATE", "t:1", "", at(0), 5, 1), ("datastream", "CREATE", "t:1", "A", at(2.5), 1, 2),
        ("object", "DELETE", "t:1", "", at(3), 0, 3), ("object", "CREATE", "t:1", "", at(3), 1, 4),
        ("datastream", "UPDATE", "t:2", "A", at(0), 5, 5), ("datastream", "DELETE", "t:2", "A", at(4), 0, 6),
        ("datastream", "UPDATE", "t:2", "B", at(0), 5, 7),
    )
    assert column(db.settle(jobs, "corrected"), "seq") == [3, 4, 6, 7]
    assert column(db.settle(jobs, "reference"), "seq") == [1, 2, 3, 4, 5, 6, 7]


def test_chunk_borders_are_seen(spark):
    border = db.SLICES_PER_CHUNK * 1000
    start = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=border)
    jobs = []
    for i, gap in enumerate([1, 4, 5, 6]):
        before = start - dt.timedelta(seconds=1)
        jobs += [("object", "UPDATE", f"t:{i}", "", before, 5, 10 * i), ("object", "UPDATE", f"t:{i}", "", before + dt.timedelta(seconds=gap), 5, 10 * i + 1)]
    assert column(db.debounce(frame(spark, *jobs)), "seq") == [1, 11, 20, 21, 30, 31]


def test_long_waits_reach_over_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(db, "SLICES_PER_CHUNK", 4)
    jobs = []
    for i, gap in enumerate([3, 19, 20, 29]):
        jobs += [("object", "UPDATE", f"t:{i}", "", at(5), 20, 10 * i), ("object", "UPDATE", f"t:{i}", "", at(5 + gap), 1, 10 * i + 1)]
    assert column(db.debounce(frame(spark, *jobs), min_delay_s=1, max_delay_s=20), "seq") == [1, 11, 20, 21, 30, 31]


def test_waits_outside_the_bounds_are_refused(spark):
    with pytest.raises(PySparkException, match="delay_s outside"):
        db.debounce(frame(spark, ("object", "CREATE", "t:1", "", at(0), 9, 1))).collect()


def test_due_and_release_order(spark):
    jobs = frame(
        spark, ("object", "CREATE", "t:1", "", at(0), 3, 1), ("object", "CREATE", "t:2", "", at(1), 1, 2),
        ("object", "CREATE", "t:3", "", at(0), 2, 0),
    )
    assert column(db.due(jobs, at(2)), "seq") == [0, 2]
    assert [r["seq"].number for r in db.release_order(jobs).collect()] == [0, 2, 1]
    assert [r["seq"].number for r in db.next_jobs(jobs, 1).collect()] == [0]
    assert "TakeOrdered" in db.next_jobs(jobs, 1)._jdf.queryExecution().executedPlan().toString()
    assert [float(r[0]) for r in jobs.orderBy("seq").select(db.remaining_s(at(1))).collect()] == [1.0, 2.0, 1.0]


def test_fan_out_only_from_creates(spark):
    listing = spark.createDataFrame([("t:1", "A"), ("t:1", "B"), ("t:2", "C")], "pid string, dsid string")
    jobs = frame(spark, ("object", "CREATE", "t:1", "", at(0), 1, 1), ("object", "UPDATE", "t:2", "", at(0), 1, 2))
    rows = fan_out(jobs, listing).collect()
    assert sorted((r["op"], r["doc_id"], r["arrival"], r["delay_s"]) for r in rows) == [
        ("CREATE", "t:1:A", at(1), 0), ("CREATE", "t:1:B", at(1), 0)
    ]


def test_count_after_matches_counting(spark):
    events = [("k", t, s) for s, t in enumerate([0, 10, 10, 3599, 3600, 9000, 9000])] + [("other", 5, 1)]
    probes = [("k", d, t, s) for d, (t, s) in enumerate([(0, 0), (10, 1), (3599, 9), (8999, 0), (9000, 6), (20000, 0)])]
    pos = F.struct(F.col("at"), F.col("seq")).alias("pos")
    e = spark.createDataFrame([(k, at(t), s) for k, t, s in events], "pid string, at timestamp_ntz, seq bigint")
    p = spark.createDataFrame([(k, str(d), at(t), s) for k, d, t, s in probes], "pid string, doc_id string, at timestamp_ntz, seq bigint")
    got = {r["doc_id"]: r["n_after"] for r in count_after(e.select("pid", pos), p.select("pid", "doc_id", pos), "pid").collect()}
    assert got == {str(d): sum(k == ek and (et, es) > (t, s) for ek, et, es in events) for k, d, t, s in probes}


# Documents


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_object_document_and_missing_profile(spark):
    profiles = spark.createDataFrame(
        [("test:1234", "A", "The label", "library", dt.datetime(2014, 5, 7, 18, 33, 33, 996000), dt.datetime(2014, 5, 7, 18, 35, 29, 636000))],
        schemas.OBJECT_PROFILES,
    )
    jobs = frame(spark, ("object", "CREATE", "test:1234", "", at(0), 1, 1), ("object", "CREATE", "test:1", "", at(0), 1, 2))
    good, bad = docs.split_failures(docs.build_objects(jobs, profiles))
    doc = one(good)["doc"]
    assert (doc["PID"], doc["STATE"], doc["LABEL"], doc["OWNER_ID"]) == ("test:1234", "A", "The label", "library")
    assert one(bad)["error_message"] == "no profile of object test:1"


def test_datastream_document_with_content(spark):
    created = dt.datetime(2008, 7, 2, 5, 9, 44, 406000)

    def profile(dsid, mime="text/xml", mark="false"):
        return ("s:Deployment-3.0", dsid, "Dublin Core", "DC1.0", created, "A", mime, None, "X", 439, mark, None, None, None, "DISABLED", "none")

    xml = b"<oai_dc:dc xmlns:oai_dc='x'><dc:title>The &amp; title</dc:title>\n<dc:identifier>id:1</dc:identifier></oai_dc:dc>"
    profiles = spark.createDataFrame([profile(d) for d in ("DC", "LOST", "GONE", "b d", "ü")] + [profile("NV", mark=None), profile("PDF", "application/pdf")], schemas.DATASTREAM_PROFILES)
    rows = [("DC", 200, xml), ("LOST", 404, b""), ("b d", 200, b""), ("ü", 200, b"<a>\xff</a>"), ("NV", 200, b""), ("PDF", 200, b"%PDF")]
    contents = spark.createDataFrame([("s:Deployment-3.0", d, s, bytearray(c)) for d, s, c in rows], schemas.CONTENTS)
    dsids = ["DC", "LOST", "GONE", "b d", "ü", "NV", "PDF", "NONE"]
    jobs = frame(spark, *[("datastream", "CREATE", "s:Deployment-3.0", d, at(0), 0, i) for i, d in enumerate(dsids)])
    built = {r["dsid"]: r for r in docs.attach_content(docs.build_datastreams(jobs, profiles), contents).collect()}
    dc = built["DC"]["doc"]
    assert (dc["SIZE"], dc["VERSIONABLE"], dc["CHECKSUM_TYPE"], dc["CREATED_DATE"]) == (439, False, "DISABLED", created)
    assert dc["CONTENT"]["_uri"] == "objects/s:Deployment-3.0/datastreams/DC/content"
    assert dc["CONTENT"]["_content"] == "The & title id:1"
    assert built["ü"]["doc"]["CONTENT"]["_uri"].endswith("/datastreams/%C3%BC/content")
    assert built["ü"]["doc"]["CONTENT"]["_content"] == "�"
    assert built["PDF"]["error_message"] is None and built["PDF"]["doc"]["CONTENT"]["_content"] is None
    messages = {d: built[d]["error_message"] for d in dsids if built[d]["error_message"]}
    assert set(messages) == {"LOST", "GONE", "b d", "NV", "NONE"}
    assert "404" in messages["LOST"] and "no content" in messages["GONE"] and "address" in messages["b d"]


@pytest.mark.parametrize("part, valid", [("a%20b", True), ("a%2", False), ("a[b", False), ("a?x=[1]", True), ("a#b#c", False), ("a|b", False), ("a b", False), ("中", True)])
def test_uri_validity(spark, part, valid):
    got = spark.range(1).select(ids.content_uri(F.lit("p:1"), F.lit(part))).first()[0]
    assert (got is not None) == valid


def test_dissemination_rules(spark):
    rows = [("ok", 200, '{"PUB_TYPE": "article", "N": 3, "D": {"x": 1}}'), ("no", 404, "{}"), ("bad", 200, "{"), ("down", None, None)]
    pids = ["ok", "no", "bad", "down", "absent"]
    diss = spark.createDataFrame([(p, "s:1", "m", s, j) for p, s, j in rows] + [("no", "s:2", "m", 200, "{}")], schemas.DISSEMINATIONS)
    profiles = spark.createDataFrame([(p, "A", "l", "o", at(0), at(0)) for p in pids], schemas.OBJECT_PROFILES)
    built = docs.build_objects(profiles.select("pid"), profiles)
    attached = docs.attach_dissemination(built, diss, "s:1", "m")
    got = {r["pid"]: (r["d"], r["error_message"]) for r in attached.select("pid", F.col("doc._dissemination._sdef_pid").alias("d"), "error_message").collect()}
    assert got["ok"] == ("s:1", None) and got["no"] == got["absent"] == (None, None)
    assert "JSON" in got["bad"][1] and "failed" in got["down"][1]
    flat = attached.where("pid = 'ok'").select(F.col("doc._dissemination._content").alias("c"))
    typed = docs.typed_properties(flat, {"PUB_TYPE": {"type": "string"}, "N": {"type": "long"}, "D": {"type": "long"}}, "c")
    assert tuple(typed.drop("c").first()) == ("article", 3, None)
    for sdef, method in [("", "m"), ("s:1", ""), (None, None)]:
        skipped = docs.attach_dissemination(built, diss, sdef, method)
        assert skipped.where("error_message IS NOT NULL OR doc._dissemination IS NOT NULL").count() == 0
        assert "dissem" not in str(skipped._jdf.queryExecution().executedPlan()).lower() or "Join" in str(skipped._jdf.queryExecution().executedPlan())


# Index tables


def object_rows(spark, *rows):
    return spark.createDataFrame([(p, None, label, None, None, None, None, p, v) for p, label, v in rows], schemas.OBJECTS)


def test_upsert_replaces_whole_rows(spark):
    current = object_rows(spark, ("t:1", "old", 1), ("t:2", "kept", 4))
    changes = object_rows(spark, ("t:1", None, 0), ("t:3", "new", 0)).drop("_version")
    table, result = index_tables.upsert(current, changes)
    assert {r["doc_id"]: (r["LABEL"], r["_version"]) for r in table.collect()} == {"t:1": (None, 2), "t:2": ("kept", 4), "t:3": ("new", 1)}
    assert {r["doc_id"]: r["created"] for r in result.collect()} == {"t:1": False, "t:3": True}


def test_errors_are_written_once_and_expire(spark):
    old = spark.createDataFrame([("t:1", "t:1", "", "j", "m", at(0)), ("t:2", "t:2", "", "j", "m", at(0))], schemas.ERRORS)
    failed = frame(spark, ("object", "CREATE", "t:1", "", at(5), 0, 1), ("object", "UPDATE", "t:1", "", at(6), 0, 2)).withColumn("error_message", F.lit("crashed"))
    rows = {r["doc_id"]: r for r in index_tables.write_errors(old, failed, at(100)).collect()}
    assert (rows["t:1"]["job"], rows["t:1"]["message"], rows["t:1"]["timestamp"]) == ("[UPDATE] [t:1]", "crashed", at(100))
    assert rows["t:2"]["message"] == "m"
    six_weeks = dt.timedelta(weeks=6)
    assert index_tables.expire_errors(old, at(0) + six_weeks).count() == 0
    assert index_tables.expire_errors(old, at(0) + six_weeks - dt.timedelta(seconds=1)).count() == 2


# Harvest


def states(spark, **cases):
    rows = [(name, *values) for name, values in cases.items()]
    return harvest.load_last_run(spark.createDataFrame(rows, schemas.LAST_RUN_RAW))


def test_harvest_state_cases(spark):
    iso = lambda d: d.strftime("%Y-%m-%dT%H:%M:%SZ")
    year, soon = dt.timedelta(days=365), dt.timedelta(seconds=3)
    state = states(
        spark, none=(None, None, None), recent=(iso(NOW), None, None), corrupt=("", "BAR", "BAZ"), future=(iso(NOW + soon), None, None),
        token=(None, None, "xyz1234"), outdated=(None, iso(NOW - year), "xyz1234"), at_limit=(None, iso(NOW), "xyz1234"), zone=("2014-06-09T19:30:00+02:00", "", ""),
    )
    plan = {r["source"]: (r["action"], r["token"], r["from_text"], r["from_ts"]) for r in harvest.plan_harvest(state, NOW).collect()}
    assert plan["none"] == plan["corrupt"] == plan["outdated"] == plan["at_limit"] == ("FULL", None, None, None)
    assert plan["token"] == ("RESUME", "xyz1234", None, None)
    # The 12-hour clock asks for 05:30 instead of 17:30.
    assert plan["recent"] == plan["zone"] == ("INCREMENTAL", None, "2014-06-09T05:30:00", NOW - dt.timedelta(hours=12))
    fixed = {r["source"]: (r["from_text"], r["from_ts"]) for r in harvest.plan_harvest(state, NOW, "corrected").collect()}
    assert fixed["recent"] == ("2014-06-09T17:30:00Z", NOW)
    runs = {r["source"]: r["next_run_at"] for r in harvest.next_run_at(state, NOW, 300).collect()}
    assert runs["future"] == NOW + soon and runs["none"] == runs["recent"] == NOW + dt.timedelta(seconds=300)
    assert runs["token"] == runs["outdated"] == NOW + dt.timedelta(seconds=1)


def test_saving_harvest_state(spark):
    before = NOW - dt.timedelta(hours=1)
    state = spark.createDataFrame(
        [("paging", before, None, "t1"), ("failing", before, None, "t1"), ("untouched", before, None, None), ("last", before, None, "t1")], schemas.LAST_RUN
    )
    new = spark.createDataFrame(
        [("paging", NOW, False, "t2", NOW), ("failing", NOW, True, "", None), ("fresh", NOW, False, "", None), ("last", NOW, False, "", None)],
        "source string, request_at timestamp_ntz, failed boolean, resumption_token string, expiration_date timestamp_ntz",
    )
    got = {m: {r["source"]: tuple(r)[1:] for r in harvest.save_last_run(state, new, m).collect()} for m in ("reference", "corrected")}
    assert got["reference"] == {
        "paging": (NOW, NOW, "t2"), "failing": (None, None, None), "fresh": (NOW, None, None), "untouched": (before, None, None), "last": (NOW, None, None)
    }
    assert got["corrected"] == {
        "paging": (before, NOW, "t2"), "failing": (before, None, "t1"), "fresh": (NOW, None, None), "untouched": (before, None, None), "last": (before, None, None)
    }


def test_state_after_several_pages(spark):
    """The time of a list's first request counts, also when lists end and begin among the pages of one batch."""
    t = [NOW + dt.timedelta(minutes=i) for i in range(6)]
    pages = [
        ("goes_on", 1, t[1], False, "b"), ("goes_on", 2, t[2], False, ""), ("begins", 1, t[1], False, "a"), ("begins", 2, t[2], False, "b"),
        ("again", 1, t[1], False, ""), ("again", 2, t[3], False, "a"), ("again", 3, t[4], False, ""), ("fails", 1, t[1], False, "a"), ("fails", 2, t[2], True, ""),
    ]
    rows = spark.createDataFrame([(*p, None) for p in pages], "source string, page_no bigint, request_at timestamp_ntz, failed boolean, resumption_token string, expiration_date timestamp_ntz")
    state = spark.createDataFrame([(s, t[0], None, "x") for s in ("goes_on", "again")] + [("fails", t[0], None, None)], schemas.LAST_RUN)
    got = {m: {r["source"]: (r["ts"], r["resumption_token"]) for r in harvest.save_last_run(state, harvest.latest_page(rows), m).collect()} for m in ("reference", "corrected")}
    assert got["reference"] == {"goes_on": (t[2], None), "begins": (t[2], "b"), "again": (t[4], None), "fails": (None, None)}
    assert got["corrected"] == {"goes_on": (t[0], None), "begins": (t[1], "b"), "again": (t[3], None), "fails": (t[0], None)}


def test_changed_since_reaches_the_scan(spark):
    path = scratch_dir(spark, "changes")
    spark.createDataFrame([("a", at(0)), ("a", at(10)), ("b", at(0)), ("c", at(0))], "source string, ts timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path)
    since = harvest.changed_since(df, "ts", at(10))
    assert since.count() == 1 and harvest.changed_since(df, "ts", None).count() == 4
    assert "GreaterThanOrEqual(ts" in since._jdf.queryExecution().executedPlan().toString()
    plan = spark.createDataFrame([("a", at(10)), ("b", None)], "source string, from_ts timestamp_ntz")
    assert sorted((r["source"], r["ts"]) for r in harvest.changed_since(df, "ts", plan).collect()) == [("a", at(10)), ("b", at(0))]


# Text


@pytest.mark.parametrize(
    "mime, content, expected",
    [
        ("text/html", "<html><head><title>t</title></head><body><p>a<b>b</b></p><p>c &amp;lt; &#228;&#x20AC; &nope; &</p><!-- x --></body>", "ab c &lt; ä€ &nope; &"),
        ("TEXT/HTML; charset=utf-8", "x<script>var a = '<p>'</script>y<style>p{}</style><script>open", "xy"),
        ("application/xml", "<?xml version='1.0'?><a><b>x</b><![CDATA[1 <2> & 3]]><c/>y</a>", "x 1 <2> & 3 y"),
        ("image/svg+xml", "<svg><text>hi</text></svg>", "hi"), ("text/plain", " as <is> &amp; ", " as <is> &amp; "),
        ("application/json", '{"a": 1}', '{"a": 1}'), ("application/pdf", "%PDF", None), (None, "x", "x"), ("text/html", "&#0;&#55296;&#1114112;", "&#0;&#55296;&#1114112;"),
    ],
)
def test_extract_text(spark, mime, content, expected):
    df = spark.createDataFrame([(mime, content)], "mime string, content string")
    assert df.select(text.extract_text(F.col("content"), F.col("mime"))).first()[0] == expected


def test_postings_count_terms_without_a_shuffle(spark):
    df = spark.createDataFrame([("d1", "A b, a! b-A", "x"), ("d2", "", None), ("d3", "Ä1 ä1", "... ")], "doc_id string, label string, body string")
    got = build_postings(df, {"LABEL": "label", "CONTENT": "body"})
    assert sorted(tuple(r) for r in got.collect()) == [
        ("CONTENT", "x", "d1", 1), ("LABEL", "a", "d1", 3), ("LABEL", "b", "d1", 2), ("LABEL", "ä1", "d3", 2)
    ]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_changed_terms_compare_texts_inside_their_row(spark):
    """Random pairs of texts against a counter of each."""
    rng = random.Random(11)
    text = lambda: rng.choice([None, "", " ".join(rng.choice("aAbcdé1") + rng.choice(["", "x"]) for _ in range(rng.randrange(12)))])
    rows = [(f"d{i}", "f", text(), text()) for i in range(300)]
    rows += [(f"e{i}", "f", t, t) for i, t in enumerate(["a b", "", None])]
    count = lambda t: Counter(w for w in re.split(r"[^a-zé0-9]+", (t or "").lower()) if w)
    expected = {
        ("f", w, d, count(new)[w]) for d, _, old, new in rows for w in count(old) | count(new) if count(old)[w] != count(new)[w]
    }
    got = changed_terms(spark.createDataFrame(rows, "doc_id string, field string, before string, after string"))
    found = [tuple(r) for r in got.collect()]
    assert set(found) == expected and len(found) == len(expected)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_texts_that_stay_make_no_terms(spark):
    """Documents written again as they were: nothing is kept of their terms; removed, renamed and new ones are told apart."""
    fields = "doc_id string, PID string, LABEL string, CONTENT struct<_content: string>"
    old = [("p:1:T", "p:1", "same", ("a b a",)), ("p:2:T", "p:2", "same", ("c",)), ("p:3:T", "p:3", "gone", None), ("p:4:T", "p:4", "gone", ("d",)), ("p:5:T", "p:5", "other", ("e",))]
    new = [("p:1:T", "p:1", "same", ("a b a",)), ("p:2:T", "p:2", "same", ("c c",)), ("p:6:T", "p:6", None, ("f",)), ("p:4:T", "p:4", "gone", ("g",))]
    objects = spark.createDataFrame([(f"p:{i}", f"p:{i}", "label") for i in range(1, 6)], "doc_id string, PID string, LABEL string")
    streams, rows = spark.createDataFrame(old, fields), spark.createDataFrame(new, fields)
    pids = spark.createDataFrame([("p:3",), ("p:4",)], "PID string")
    changes = {
        "objects": index_tables.Change(objects.where("PID = 'p:1'"), None, pids),
        "datastreams": index_tables.Change(rows, spark.createDataFrame([("p:5:T", "p:5"), ("p:1:T", "p:1")], "doc_id string, PID string"), pids),
    }
    kept = []

    def keep(df, name):
        kept.extend(df.collect())
        return df

    change = postings_change(index_tables.IndexTables(objects, streams, objects.limit(0)), changes, keep)
    content, label = "datastreams.CONTENT", "datastreams.LABEL"
    assert sorted(tuple(r) for r in change.rows.collect()) == [(content, "c", "p:2:T", 2), (content, "f", "p:6:T", 1), (content, "g", "p:4:T", 1)]
    assert sorted(tuple(r) for r in change.documents.collect()) == [
        (content, "d", "p:4:T"), (content, "e", "p:5:T"), (label, "gone", "p:3:T"), (label, "other", "p:5:T"),
        ("objects.LABEL", "label", "p:3"), ("objects.LABEL", "label", "p:4"),
    ]
    assert len(kept) == 9


@pytest.mark.parametrize("value, expected", [("oai:example.org:col:1044", "col:1044"), ("oai:x", "oai:x"), ("a:b", "a:b"), ("", ""), ("abcd:e:f", "e:f"), ("oai::x", "x")])
def test_local_identifier(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(ids.local_identifier(F.col("v"))).first()[0] == expected


# Order keys, waits, sources


def test_order_of_long_pages(spark):
    """Entries beyond 100,000 of a page, and page numbers taken from long time stamps, keep their order."""
    from shelfmark.operators.jobs import jobs_from_identifiers

    rows = [("s", n, at(0), p, "p:1") for n, p in [(1, 0), (1, 99_999), (1, 100_000), (1, 2_000_000), (2, 0), (20240101123000123, 5)]]
    listed = spark.createDataFrame(rows, "source string, page_no bigint, request_at timestamp_ntz, position int, pid string")
    found = db.release_order(jobs_from_identifiers(listed)).collect()
    assert [(r["seq"].number, r["seq"].position) for r in found] == [(n, p) for _, n, _, p, _ in rows]
    assert len({r["seq"] for r in found}) == len(rows)


def test_fan_out_follows_all_feeds_at_equal_times(spark):
    listing = spark.createDataFrame([("t:1", "A")], "pid string, dsid string")
    jobs = frame(spark, ("object", "CREATE", "t:1", "", at(0), 0, (1 << 62) + 5), ("datastream", "UPDATE", "t:1", "A", at(0), 0, (1 << 62) + 9))
    rows = db.release_order(jobs.unionByName(fan_out(jobs, listing))).collect()
    assert [(r["op"], r["seq"].generation) for r in rows] == [("CREATE", 0), ("UPDATE", 0), ("CREATE", 1)]


@pytest.mark.parametrize("longest", [7, 64, 86_400])
def test_interruptions_with_very_different_waits(spark, longest):
    import random

    rng = random.Random(longest)
    delays = [d for d in (1, 2, 3, 7, 63, 64, 65, 86_399, 86_400) if d <= longest] + [0]
    jobs = [("object", "UPDATE", f"p:{i % 7}", "", at(rng.randint(0, 3 * longest)), rng.choice(delays), i) for i in range(300)]
    events = [(f"p:{i % 7}", at(rng.randint(0, 4 * longest)), 1000 + i) for i in range(40)]
    df = spark.createDataFrame(events, "pid string, at timestamp_ntz, n bigint")
    df = df.select("pid", "at", F.struct(F.lit(0).alias("generation"), F.lit(0).alias("feed"), F.lit("").alias("source"), F.col("n").alias("number"), F.lit(0).cast("bigint").alias("position")).alias("seq"))
    got = {r["seq"].number: r["interrupted"] for r in db.mark_interrupted(frame(spark, *jobs), df, "pid", 1, longest).collect()}
    for _, _, pid, _, arrival, delay, n in jobs:
        hit = any(e == pid and (t, m) > (arrival, n) and t < arrival + dt.timedelta(seconds=delay) for e, t, m in events)
        assert got[n] == (delay > 0 and hit), (n, delay)


def test_debounce_with_waits_of_a_second_and_a_day(spark):
    jobs = [("object", "UPDATE", "t:1", "", at(t), d, n) for n, (t, d) in enumerate([(0, 86_400), (5_000, 1), (5_002, 86_400), (90_000, 1), (90_003, 1), (90_004, 86_400)])]
    assert column(db.debounce(frame(spark, *jobs), min_delay_s=1, max_delay_s=86_400), "seq") == [1, 3, 4, 5]


def test_plan_of_configured_sources(spark):
    state = spark.createDataFrame([("old", NOW, None, None), ("gone", NOW, None, None)], schemas.LAST_RUN)
    sources = spark.createDataFrame([("old",), ("new",), ("new",)], "source string")
    got = {r["source"]: r["action"] for r in harvest.plan_harvest(state, NOW, sources=sources).collect()}
    assert got == {"old": "INCREMENTAL", "new": "FULL"}


def test_smallest_bound_reaches_the_scan(spark):
    path = scratch_dir(spark, "changed")
    spark.createDataFrame([("a", at(0)), ("a", at(9)), ("b", at(9))], "source string, ts timestamp_ntz").write.parquet(path)
    plan = spark.createDataFrame([("a", at(5)), ("b", at(7))], "source string, from_ts timestamp_ntz")
    found = harvest.changed_since(spark.read.parquet(path), "ts", plan)
    assert found.count() == 2
    assert "GreaterThanOrEqual(ts," in found._jdf.queryExecution().executedPlan().toString()


def test_sources_read_whole_do_not_widen_the_scan_of_the_others(spark):
    path = scratch_dir(spark, "changed")
    spark.createDataFrame([(s, at(t)) for s in ("a", "b", "full", "unplanned") for t in (0, 9)], "source string, ts timestamp_ntz").write.parquet(path)
    plan = spark.createDataFrame([("a", at(5)), ("b", at(10)), ("full", None)], "source string, from_ts timestamp_ntz")
    found = harvest.changed_since(spark.read.parquet(path), "ts", plan)
    assert sorted((r["source"], r["ts"]) for r in found.collect()) == [("a", at(9)), ("full", at(0)), ("full", at(9))]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in text and "EqualTo(source,full)" in text
    none = harvest.changed_since(spark.read.parquet(path), "ts", plan.limit(0))
    assert none.count() == 0


def test_counted_fan_out_stands_for_the_jobs(spark):
    listing = spark.createDataFrame([("t:1", "A"), ("t:1", "B"), ("t:2", "C"), ("t:3", "D")], "pid string, dsid string")
    rows = [("object", "CREATE", "t:1", "", at(t), 1, n) for n, t in enumerate([0, 5, 5, 3])] + [("object", "CREATE", "t:2", "", at(1), 0, 9), ("object", "UPDATE", "t:3", "", at(0), 1, 8)]
    created = frame(spark, *rows)
    jobs = fan_out(created, listing).groupBy("pid", "dsid", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("arrival", "seq")).alias("last"))
    assert sorted(map(str, fan_out_counted(created, listing).collect())) == sorted(map(str, jobs.collect()))


def test_only_crowded_keys_are_salted(spark):
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("pid"), "id")
    one = many.select("pid").distinct().withColumn("n", F.length("pid"))
    crowd = measure(many, ("pid",), least_rows=100)
    assert len(crowd.keys[("pid",)]) == 1 and measure(many, ("pid",)).keys == {("pid",): ()}
    joined = salted_lookup(many, one, ["pid"], ["id"], crowd=crowd)
    assert joined.count() == 3000 and joined.where("n <> length(pid)").count() == 0
    # Only the crowded key is repeated: one row more per further salt.
    copies = one.count()
    repeated = one.withColumn("_salt", F.explode(F.when(crowd.crowded(["pid"]), F.sequence(F.lit(0), F.lit(7))).otherwise(F.array(F.lit(0)))))
    assert repeated.count() == copies + 7
    salts = many.where(crowd.crowded(["pid"])).groupBy(F.pmod(F.xxhash64("id"), F.lit(8)).alias("s")).count().collect()
    assert len(salts) == 8 and max(r["count"] for r in salts) < 2 * 1000 / 8
    plain = salted_lookup(many, one, ["pid"], ["id"], crowd=measure(many, ("pid",)))
    assert "_salt" not in plain._jdf.queryExecution().toString() and plain.count() == 3000


def test_counting_after_spreads_one_crowded_hour(spark):
    """One object with all CREATEs in one hour: its ranges hold about equally many."""
    events = spark.range(8000).select(F.lit("k").alias("pid"), F.struct(ntz(at(0)).alias("at"), F.col("id").alias("seq")).alias("pos"))
    probes = spark.createDataFrame([("k", "d0", at(0), -1), ("k", "d1", at(0), 3999), ("k", "d2", at(0), 7999)], "pid string, doc_id string, at timestamp_ntz, seq bigint")
    kept = []

    def keep(df, name):
        kept.append(materialize(df, name))
        return kept[-1]

    found = count_after(events, probes.select("pid", "doc_id", F.struct("at", "seq").alias("pos")), "pid", keep)
    assert {r["doc_id"]: r["n_after"] for r in found.collect()} == {"d0": 8000, "d1": 4000, "d2": 0}
    sizes = [r["count"] for r in kept[0].groupBy("_range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * 8000 / 4


def test_document_without_pid_fails_with_a_message(spark):
    profiles = spark.createDataFrame([], schemas.OBJECT_PROFILES)
    good, bad = docs.split_failures(docs.build_objects(spark.createDataFrame([(None,), ("p:1",)], "pid string"), profiles))
    assert good.count() == 0 and bad.count() == 2
    kinds = spark.createDataFrame([("datastream", None, "D"), ("datastream", "p", None), ("object", "p", "D")], "kind string, pid string, dsid string")
    assert [r[0] for r in kinds.select(ids.doc_id(F.col("kind"), F.col("pid"), F.col("dsid"))).collect()] == [None, "p", "p"]


def test_character_references(spark):
    raw = "&Eacute;&rarr; &copy 2020 &notit; &#233;&#xE9; &#00065; &#99999999999; &unknown; & &;"
    got = spark.createDataFrame([(raw,)], "t string").select(text.unescape(F.col("t"))).first()[0]
    assert got == "É→ © 2020 ¬it; éé A &#99999999999; &unknown; & &;"


@pytest.mark.parametrize(
    "content, mime, expected",
    [
        ("plain wörds".encode(), None, "plain wörds"), ("<html><body>é &rarr; x</body></html>".encode("latin1"), "text/html; charset=ISO-8859-1", "é → x"),
        ("<?xml version='1.0' encoding='ISO-8859-1'?><a>é “</a>".encode("cp1252"), "text/xml", "é “"), (b"<!DOCTYPE html><p>hi</p>", "application/octet-stream", "hi"),
        (b"\x00\x01%PDF", "application/octet-stream", None), ("äö".encode("utf-16"), "text/plain; charset=utf-16", "äö"),
        ("<html><head><meta charset='windows-1252'></head><body>\x80</body>".encode("latin1"), "text/html", "€"), (b"\xff ok", "text/plain", "� ok"),
        (b"<?xml version='1.0'?><r>a</r>", "", "a"), (None, None, None),
    ],
)
def test_text_by_charset_and_detected_type(spark, content, mime, expected):
    df = spark.createDataFrame([(content, mime)], "content binary, mime string")
    assert df.select(text.extract_text(F.col("content"), F.col("mime"))).first()[0] == expected
