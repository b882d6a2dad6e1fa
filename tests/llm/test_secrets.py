"""Spans against the patterns in Python; the ledger by what it scans."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from compare import check, connect
from siltstone.llm.secrets import OP5_SQL, RULES, digest, op5_secret_scan, redacted, scan
from siltstone.sources.stage import scratch_path

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [
    ("assign", ASSIGN, 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24),
    ("key", RULES[3].pattern, 0, 1), ("github", RULES[4].pattern, 0, 40), ("jwt", RULES[5].pattern, 0, 30),
]


def plain(text):
    found = []
    for order, (kind, pattern, group, least) in enumerate(KINDS):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m.group(group)) >= least:
                found.append((m.start(), order, m.end(), kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


HEX = "0123456789abcdef" * 2
TEXTS = [
    None, "", "nothing", "password=abcdef", "PassWord: 'abc' token=token: abcdefgh", "secret=token: abcdefgh secret = \"x1/+=-_.\"", "é😀 api_key=ABCDEFG, apikey:zzzzzz ApI_KeY==abcdef",
    f"{HEX} {HEX[:23]} x{HEX}g{HEX}", f"AKIA{'A' * 16} AKIAKIA{'B' * 14} AKIA{'9' * 15} akia{'A' * 20}", f"token={HEX}", "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 20,
    "eyJabcdefgh0.eyJabcdefgh1.sig_nature-x", "token=abcdef" * 5, f"passwd = '{HEX}' AKIA{HEX.upper()}", "x " * 20000 + f"token={HEX}", "ſecret=abcdefgh toKen=abcdefgh",
]


def test_small(spark):
    rng = random.Random(2)
    pieces = ["token", "=", ":", " ", '"', "secret", "abcdef", "AKIA", "A" * 16, HEX, "é", "x", "api_key", "'", "PASSWD", "ab12cd"]
    texts = TEXTS + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, TEXTS[3]), (1000, TEXTS[3]), (3, TEXTS[3])]
    docs = spark.createDataFrame([(i, t, "d", 1, "p") for i, t in rows], "doc_id long, text string, digest string, spans int, path string")
    got = scan(docs, scratch_path(spark, "ledger")).collect()
    assert all(r.digest == hashlib.sha256((dict(rows).get(r.path) or "").encode()).hexdigest() for r in got if r.path is not None)
    assert sorted(((r.path, [f"{s.kind}:{s.start}:{s.end}" for s in r.spans]) for r in got), key=repr) == sorted(((i, plain(t)) for i, t in rows), key=repr)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op5_secret_scan(spark, sf_dir)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    found = got.collect()
    assert len(found) == len(texts) and any(r.n_assign for r in found)
    for r in found:
        spans = plain(texts[r.doc_id])
        base = [s for s in spans if s.split(":")[0] in ("assign", "access", "hex")]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert r.spans == ",".join(spans)


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert check(spark, connect(sf_dir), op5_secret_scan, OP5_SQL, sf_dir) == 1000


def test_no_python(spark):
    plan = op5_secret_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_ledger(spark):
    ledger = scratch_path(spark, "ledger")
    first = spark.createDataFrame([(1, "token=abcdef"), (2, "plain"), (3, "token=abcdef")], "doc_id long, text string")
    second = first.union(spark.createDataFrame([(4, "passwd=abcdefg"), (5, "plain")], "doc_id long, text string"))
    scan(first, ledger).collect()
    seen = lambda: spark.read.parquet(f"{ledger}/seen")
    assert seen().count() == 2
    got = scan(second, ledger).collect()
    assert seen().count() == 3 and {r.path: len(r.spans) for r in got} == {1: 1, 2: 0, 3: 1, 4: 1, 5: 0}
    assert scan(second, ledger).count() == 5 and seen().count() == 3
    # a new version of one rule is due for every blob, the others for none
    newer = (RULES[0]._replace(version=2, least=7), *RULES[1:])
    got = scan(second, ledger, newer).collect()
    assert {r.path: len(r.spans) for r in got} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 0}
    last = seen().where(F.array_contains("keys", "assign@2"))
    assert last.count() == 3 and last.where(F.size("keys") != 1).count() == 0
    # findings of an interrupted scan that the ledger does not call seen
    spark.createDataFrame([("x", "assign@1", 0, 1)], "digest string, rule string, start long, end long").write.mode("append").parquet(f"{ledger}/findings")
    assert scan(first, ledger).count() == 3


def test_redaction_and_edges(spark):
    docs = spark.createDataFrame([(1, f"a token={HEX} b 😀 password=abcdef", "s", 9), (2, "plain", "s", 5), (None, None, "s", None)], "doc_id long, text string, source string, n_chars long")
    out = redacted(docs, scratch_path(spark, "ledger"))
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {1: ("a [secret] b 😀 [secret]", 23), 2: ("plain", 5), None: (None, None)}
    empty = docs.limit(0)
    assert scan(empty, scratch_path(spark, "ledger")).count() == 0 and redacted(empty, scratch_path(spark, "ledger")).count() == 0
    assert docs.select(digest(F.col("text")).alias("d")).where("d is null").count() == 0
