"""Messages, pages, repository inputs and configuration."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.config import PipelineConfig, parse_duration
from shelfmark.operators import filters
from shelfmark.operators.jobs import derive_jobs, jobs_from_identifiers
from shelfmark.session import scratch_dir
from shelfmark.sources import messages as msg
from shelfmark.sources import pages, repository

T0 = dt.datetime(2014, 5, 7, 18, 0)


def atom(*categories):
    body = "".join(f'<category term="{t}" scheme="fedora-types:{s}" label="xsd:string"/>' for s, t in categories)
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<!-- a comment -->\n'
    return f'{head}<entry xmlns="http://www.w3.org/2005/Atom"><title type="text">x</title>{body}</entry>'


CASES = [
    ("ingest", atom(("logMessage", "")), [("object", "CREATE", "", 1)]),
    ("addDatastream", atom(("pid", "p"), ("dsID", "ADDED"), ("dsLabel", "l")), [("datastream", "CREATE", "ADDED", 1)]),
    ("modifyObject", atom(("pid", "p")), [("object", "UPDATE", "", 5)]),
    ("modifyDatastreamByValue", atom(("dsID", "M")), [("object", "UPDATE", "M", 1), ("datastream", "UPDATE", "M", 5)]),
    ("modifyDatastreamByReference", atom(("dsID", "M")), [("object", "UPDATE", "M", 1), ("datastream", "UPDATE", "M", 5)]),
    ("setDatastreamState", atom(("dsID", "M")), [("object", "UPDATE", "M", 1), ("datastream", "UPDATE", "M", 5)]),
    ("purgeDatastream", atom(("dsID", "P"), ("dsID", "second")), [("datastream", "DELETE", "P", 0)]),
    ("purgeObject", atom(("pid", "p")), [("object", "DELETE", "", 0)]),
    ("getObjectXML", atom(("pid", "p")), []),
    ("unknown", atom(), []),
    ("addDatastream", atom(), [("datastream", "CREATE", "", 1)]),
]
BROKEN = [("ingest", "<entry><broken"), ("addDatastream", "<entry>"), ("purgeObject", ""), (None, atom())]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, "fedora.apim.update", "test-rest:1", m, b, T0) for i, (m, b, _) in enumerate(CASES)]
    rows += [(100 + i, "fedora.apim.update", "test-rest:1", m, b, T0) for i, (m, b) in enumerate(BROKEN)]
    rows += [(200, "fedora.apim.update", "test-rest:1", "ingest", None, T0)]
    messages = spark.createDataFrame(rows, schemas.MESSAGES)
    return msg.parse_atom(msg.text_messages(messages))


def test_every_method_gives_its_jobs(parsed):
    good, _ = msg.split_malformed(parsed)
    found = {}
    for j in derive_jobs(good).orderBy("seq").collect():
        found.setdefault(j["seq"].number, []).append((j["kind"], j["op"], j["dsid"], j["delay_s"]))
        assert j["ready_at"] - j["arrival"] == dt.timedelta(seconds=j["delay_s"])
        assert j["doc_id"] == ("test-rest:1" if j["kind"] == "object" or not j["dsid"] else f"test-rest:1:{j['dsid']}")
    assert found == {i: jobs for i, (_, _, jobs) in enumerate(CASES) if jobs}


def test_malformed_messages_are_set_aside(parsed):
    _, bad = msg.split_malformed(parsed)
    assert {r["msg_id"] for r in bad.collect()} == {100, 101, 102, 103}
    # Methods that need no datastream id survive a broken body when corrected.
    good, bad = msg.split_malformed(parsed, "corrected")
    assert {r["msg_id"] for r in bad.collect()} == {101, 103}
    assert {100, 102} <= {r["msg_id"] for r in good.collect()}


@pytest.mark.parametrize(
    "pattern, expected",
    [
        ("repo.apim.*", {"repo.apim.update", "repo.apim.access"}), ("repo.>", {"repo.apim.update", "repo.apim.access", "repo.apim.a.b"}),
        ("repo.apim.update", {"repo.apim.update"}), ("*.apim.update", {"repo.apim.update"}), (">", None),
    ],
)
def test_topic_filter(spark, pattern, expected):
    topics = {"repo.apim.update", "repo.apim.access", "repo.apim.a.b", "repoXapim.update"}
    df = spark.createDataFrame([(t,) for t in sorted(topics)], "topic string")
    assert {r["topic"] for r in msg.topic_filter(df, pattern).collect()} == (expected or topics)


def test_selector_reaches_the_scan(spark):
    path = scratch_dir(spark, "messages")
    rows = [(i, "t", f"p:{i}", m, "<a/>", T0) for i, m in enumerate(["ingest", "modifyObject", "setDatastreamState", "purgeObject"])]
    spark.createDataFrame(rows, schemas.MESSAGES).write.parquet(path)
    messages = msg.read_messages(spark, path, "parquet")
    picked = msg.message_selector(messages, "methodName LIKE 'modify%' OR methodName = 'ingest'")
    assert {r["method_name"] for r in picked.collect()} == {"ingest", "modifyObject"}
    assert msg.message_selector(messages, "").count() == 4
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(method_name,modify)" in plan


def page(identifiers, token=None, expires=None):
    headers = "".join(
        f"<header{' status=' + chr(34) + 'deleted' + chr(34) if gone else ''}><identifier>{i}</identifier>"
        f"<datestamp>2014-06-09T00:00:00Z</datestamp></header>"
        for i, gone in identifiers
    )
    date = f' expirationDate="{expires}" completeListSize="1515" cursor="0"' if expires else ""
    tail = "" if token is None else f"<resumptionToken{date}>{token}</resumptionToken>"
    return f'<?xml version="1.0"?><OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListIdentifiers>{headers}{tail}</ListIdentifiers></OAI-PMH>'


@pytest.fixture(scope="module")
def harvested(spark):
    one = [("oai:example.org:col:1044", False)]
    rows = [
        ("s", 1, T0, 200, page(one)),
        ("s", 2, T0, 200, page(one, "140225245500000", "2014-06-09T18:34:15Z")),
        ("s", 3, T0, 200, page([("oai:x", True), ("noprefix", False)], "")),
        ("s", 4, T0, 503, page(one)), ("s", 5, T0, 200, None), ("s", 6, T0, 200, "<broken"),
        ("s", 7, T0, 200, page(one, "t", "not a date")),
    ]
    return spark.createDataFrame(rows, schemas.HARVEST_PAGES)


def test_identifiers_and_jobs(harvested):
    rows = pages.explode_identifiers(harvested)
    got = [(r["page_no"], r["identifier"], r["pid"], r["deleted"]) for r in rows.orderBy("page_no", "position").collect()]
    whole = "oai:example.org:col:1044"
    assert got == [
        (1, whole, "col:1044", False), (2, whole, "col:1044", False), (3, "oai:x", "oai:x", True),
        (3, "noprefix", "noprefix", False), (7, whole, "col:1044", False),
    ]
    ops = {m: {r["pid"]: r["op"] for r in jobs_from_identifiers(rows, m).collect()} for m in ("reference", "corrected")}
    assert set(ops["reference"].values()) == {"CREATE"}
    assert ops["corrected"] == {"col:1044": "CREATE", "noprefix": "CREATE", "oai:x": "DELETE"}


def test_page_state(harvested):
    got = {r["page_no"]: (r["failed"], r["resumption_token"], r["expiration_date"]) for r in pages.page_state(harvested).collect()}
    assert got[1] == got[3] == (False, "", None)
    assert got[2] == (False, "140225245500000", dt.datetime(2014, 6, 9, 18, 34, 15))
    assert got[4] == got[5] == got[6] == got[7] == (True, "", None)


def test_page_and_content_files(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "page-7.xml").write_text(page([("oai:a:b", False)]))
    read = pages.read_page_files(spark, str(tmp_path / "pages"), "s")
    assert [(r["page_no"], r["pid"]) for r in pages.explode_identifiers(read).collect()] == [(7, "b")]
    (tmp_path / "contents" / "test%3A1").mkdir(parents=True)
    (tmp_path / "contents" / "test%3A1" / "DC").write_bytes(b"abc")
    rows = repository.read_content_files(spark, str(tmp_path / "contents")).collect()
    assert [(r["pid"], r["ds_id"], r["status"], bytes(r["content"])) for r in rows] == [("test:1", "DC", 200, b"abc")]


def test_message_stream(spark, tmp_path):
    line = {"msg_id": 1, "topic": "t", "pid": "p:1", "method_name": "ingest", "body": atom(), "arrival": "2024-01-01T00:00:00"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(line) + "\n" + json.dumps({**line, "msg_id": 2, "body": None}))
    stream = msg.read_messages(spark, str(tmp_path / "in"), streaming=True)
    query = stream.writeStream.format("memory").queryName("landed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r["msg_id"] for r in spark.table("landed").collect()] == [1]


CONFIG = {
    "index": {
        "name": "mine", "exclude_datastreams": ["DC", "RELS-EXT"], "pid_match": r"^changeme:\d+$",
        "dissemination": {"sdef_pid": "changeme:SDef", "method": "get", "relevant_datastreams": "MODS", "properties": {"PUB_TYPE": {"type": "string"}}},
    },
    "jms": {"brokerUrl": "tcp://localhost:61616", "messageSelector": "methodName = 'ingest'"},
    "fedora": {"url": "http://localhost:8080/fedora"},
    "oai": {"poll_interval": "1m"},
}


def test_config_modes():
    cfg = PipelineConfig.from_json(json.dumps(CONFIG))
    assert (cfg.index_name, cfg.relevant_datastreams, cfg.poll_interval_s) == ("fedora", (), 60)
    assert (cfg.exclude_datastreams, cfg.sdef_pid, cfg.topic_filter) == (("DC", "RELS-EXT"), "changeme:SDef", "fedora.apim.*")
    fixed = PipelineConfig.from_json(CONFIG, "corrected")
    assert (fixed.index_name, fixed.relevant_datastreams) == ("mine", ("MODS",))
    assert len(filters.predicates_from_config(cfg)) == 2 and len(filters.predicates_from_config(fixed)) == 3
    assert filters.predicates_from_config(PipelineConfig()) == []
    assert cfg.delays_s == (1, 5)


@pytest.mark.parametrize("missing", ["jms", "fedora", "oai"])
def test_required_blocks(missing):
    settings = {k: v for k, v in CONFIG.items() if k != missing}
    with pytest.raises(ValueError):
        PipelineConfig.from_json(settings)
    if missing == "oai":
        assert PipelineConfig.from_json(settings, "corrected").harvest_url is None


def test_durations():
    assert [parse_duration(v) for v in ("5m", "1500", 250, "90s", "2h", "500ms")] == [300, 1.5, 0.25, 90, 7200, 0.5]
    with pytest.raises(ValueError):
        parse_duration("soon")


def test_bucketed_repository_is_pruned(spark):
    root = scratch_dir(spark, "repository")
    empty = {n: spark.createDataFrame([], s) for n, s in repository.TABLES.items()}
    profiles = spark.createDataFrame([(f"p:{i}", "A", "l", "o", T0, T0) for i in range(40)], schemas.OBJECT_PROFILES)
    repository.write_repository(repository.Repository(**{**empty, "object_profiles": profiles}), root, 4)
    read = repository.read_repository(spark, root, buckets=4)
    assert read.object_profiles.count() == 40
    cut = read.only({1}, 4).object_profiles
    assert 0 < cut.count() < 40
    assert "pid_bucket" in cut._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert read.only({1}, 8) is read
    assert cut.where(F.col("pid_bucket") != 1).count() == 0
