"""License places and template blocks against a plain search, and SQL over the small tables."""

import math
import random
import re

from compare import check, connect
from siltstone.llm.licenses import OP4_SQL, PHRASES, TEMPLATES, _shape, license_scan, op4_license_scan

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(doc, text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts, base = [], set()
    for phrase, label in PHRASES:
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += found
        base |= {label} if found else set()
    met = {}
    size, step = _shape(TEMPLATES)
    for b in range(math.ceil(len(words) / step)):
        block = set(words[step * b : step * b + size])
        for template, label, needs, bars in TEMPLATES:
            tokens = set(template.split())
            if len(block & tokens) >= math.ceil(0.8 * len(tokens)) and set(needs.split()) <= block and not set(bars.split()) & block:
                met.setdefault(label, []).append(len(block & tokens) / len(tokens))
    score = 1.0 if starts else max((c for x in met.values() for c in x), default=0.0)
    return (doc, len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(base | set(met)), sum(map(len, met.values())), score)


def test_small(spark, rows):
    rng = random.Random(8)
    vocabulary = sorted({w for t in TEMPLATES for x in (t.text, t.bars) for w in x.split()}) + ["filler", "É", "x9"]
    data = [
        (0, None), (1, ""), (2, " .,"), (3, "under the MIT license"), (4, "Under the mit, license under THE MIT license cc-by-nc cc by nc cc by nc"),
        (5, "x " * 31 + TEMPLATES[-1].text.upper() + " y" * 100), (None, "Apache License, Version 2.0"), (3, "under the MIT license"), (6, "cc by cc by nc"), (7, "word " * 9000 + "cc by nc"),
    ]
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 150))]
        template = rng.choice(TEMPLATES)[0].split()
        if rng.random() < 0.7:
            words[rng.randint(0, len(words)) :] = [w for w in template if rng.random() < 0.9]
        data.append((10 + i, " ".join(words)))
    docs = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in data], "doc_id long, text string, words string, row int, label string")
    got = license_scan(docs)
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, len(r.blocks), r.score) for r in got.collect()), key=repr)
    assert got == sorted((plain(d, t) for d, t in data), key=repr)
    assert license_scan(docs.limit(0)).collect() == []


def test_no_python(spark):
    plan = op4_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert check(spark, connect(sf_dir), op4_license_scan, OP4_SQL, sf_dir) == 1000


def test_long_templates(spark):
    """A template of any length is met wherever it stands."""
    notices = [(" ".join(f"{x}{i}" for i in range(size)), x) for x, size in (("a", 5), ("b", 50), ("c", 200))]
    docs = spark.createDataFrame([(f"{label} {first}", "x " * first + text + " y" * 20) for text, label in notices for first in range(0, 64, 7)], "doc_id string, text string")
    got = license_scan(docs, templates=notices, phrases=PHRASES).collect()
    assert len(got) == 30 and all(r.labels == [r.doc_id[0]] and r.score == 1.0 for r in got)


def test_telling_words(spark):
    """What names another license, or none, gives no label; whole notices and slightly changed ones do."""
    notices = {t.label: t.text for t in TEMPLATES}  # the longest of each comes last but for mpl-2
    cases = {
        "Released under the BSD license": ["bsd"], "Released under the Apache license": [], "Released under the license": [],
        "GNU General Public License version 2.0": [], "Licensed under the GNU General Public License version 2.0": [], "Licensed under the GNU Lesser General Public License, version 3": [],
        "CC BY-SA 4.0": [], "Licensed under CC BY 4.0": [], "Licensed under CC BY-NC-SA 4.0": ["cc-by-nc"], "licensed under a Creative Commons Attribution 4.0 International License": [],
        "Licensed under the Apache License, Version 2.0": ["apache-2"], "Licensed under the GNU General Public License version 3": ["gpl-3"],
        **{f"Some words before. {text} and some after": [label] for label, text in notices.items()},
        notices["gpl-3"].replace("version 3", "version 2"): [], notices["mit"].replace("merge publish ", ""): ["mit"],
    }
    got = {r.doc_id: r.labels for r in license_scan(spark.createDataFrame([(t, t) for t in cases], "doc_id string, text string")).collect()}
    assert got == cases
