import hashlib
import re

from pyspark.sql import functions as F

from touchline.llm import secrets
from touchline.llm.queries import op2_secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    out = []
    for m in ASSIGN.finditer(text or ""):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text or ""):
        if len(m[0]) >= 16:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text or ""):
        if len(m[0]) >= 32:
            out.append((m.start(), 2, "hex", m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


TEXTS = [
    None, "", "nothing here", "token=secret=abcdefgh1", "token:secret: abcdefghijk", "api_key = 'abcdefg' password: \"12345678\"", "é😀 PASSWD=xxxxxxxx é apikey:yyyyyyyy",
    "XAKIAKIA0123456789AB AKIA0123456789A AKIA01234567890", "0" * 31 + " " + "a" * 32 + "g" + "f" * 40, "secret=" + "0123456789abcdef" * 4, "token=abcdefgh" * 300, "x" * 200_000 + " token=longlonglong",
]


def frame(spark):
    rows = [(i, t, "s", 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "s", 1), (100, TEXTS[5], "s", 1), (None, TEXTS[5], "s", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, blob string, findings int")


def test_base_spans_equal_brute_force(spark):
    found, _ = secrets.scan_versions(frame(spark).withColumnRenamed("doc_id", "path"))
    base = secrets.joined_spans(F.filter("findings", lambda x: x["ord"] < 3))
    got = sorted((str(r[0]), r[1]) for r in found.select("path", base).collect())
    assert got == sorted((str(r["doc_id"]), brute(r["text"])) for r in frame(spark).collect())


def test_query_digest(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    for r in op2_secret_scan(spark, str(tmp_path)).filter("doc_id is not null").collect():
        spans = brute(TEXTS[r["doc_id"]] if r["doc_id"] < 50 else TEXTS[5])
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert r["n_hex"] == spans.count("hex:") and r["n_assign"] == spans.count("assign:")


def test_ledger_is_incremental(spark):
    rows = frame(spark).withColumnRenamed("doc_id", "path")
    full, ledger = secrets.scan_versions(rows)
    again, fresh = secrets.scan_versions(rows, ledger)
    assert fresh.isEmpty()
    key = [F.col("path"), secrets.joined_spans(F.col("findings")).alias("s")]
    assert again.select(*key).exceptAll(full.select(*key)).isEmpty()
    newer = tuple(secrets.Rule(r.kind, r.pattern, "9", r.group, r.at_least) if r.kind == "hex" else r for r in secrets.RULES)
    _, only = secrets.scan_versions(rows, ledger, newer)
    assert {r[0] for r in only.select("kind").distinct().collect()} == {"hex"}


def test_redaction(spark):
    out = {r["doc_id"]: r for r in secrets.redact_documents(frame(spark).withColumn("n_chars", F.length("text").cast("long"))).filter("doc_id is not null").collect()}
    assert out[0]["text"] is None and out[2]["text"] == "nothing here" and out[9]["text"] == "[secret]" and out[9]["n_chars"] == 8
    assert out[5]["text"] == "api_key = 'abcdefg' [secret]\"" and out[5]["blob"] == "s"
    assert secrets.redact_documents(frame(spark).limit(0)).count() == 0 and secrets.redact_documents(frame(spark)).count() == len(TEXTS) + 3


def test_redaction_reads_the_ledger(spark):
    rows = frame(spark)
    _, ledger = secrets.scan_versions(rows.withColumnRenamed("doc_id", "path"))
    key = ["doc_id", "text"]
    assert secrets.redact_documents(rows, ledger=ledger).select(*key).exceptAll(secrets.redact_documents(rows).select(*key)).isEmpty()
    # What the ledger does not say of a blob it knows is not found again.
    silent = ledger.withColumn("findings", F.slice("findings", 1, 0))
    assert secrets.redact_documents(rows, ledger=silent).select(*key).exceptAll(rows.select(*key)).isEmpty()


def test_private_keys_and_many_findings(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----\nMIIB" + "AbC/+9=" * 30 + "\nxyz=\n-----END RSA PRIVATE KEY-----"
    rows = [(1, f"a {key} b"), (2, "a -----BEGIN PRIVATE KEY-----\nMIIBabc\nQQ== and on"), (3, "token=abcdefgh " * 5000)]
    out = {r["doc_id"]: r["text"] for r in secrets.redact_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: "a [secret] b", 2: "a [secret] and on", 3: "[secret] " * 5000}
