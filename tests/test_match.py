import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from siltstone.operators import match
from siltstone.operators.match import Rules, Side, exact_match, fuzzy_match, match_cascade, name_pairs, unmatched
from siltstone.sources.stage import scratch_path

NAMES = st.lists(st.one_of(st.none(), st.text(alphabet="abB", min_size=3, max_size=11)), min_size=1, max_size=25)
SLOW = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
    return row[-1]


def close(a, b, threshold=2):
    return a and b and len(a) > 5 and len(b) > 5 and distance(a.lower(), b.lower()) <= threshold


def sides(spark, left, right):
    a = spark.createDataFrame(list(enumerate(left)), "aid int, an string")
    b = spark.createDataFrame(list(enumerate(right)), "bid int, bn string")
    return Side(a, "aid", "an"), Side(b, "bid", "bn")


@pytest.mark.parametrize("rules", [Rules(), Rules(hot_bucket=2), Rules(neighbour_cost=0.01, hot_bucket=2), Rules(neighbour_cost=0)])
@SLOW
@given(left=NAMES, right=NAMES)
def test_fuzzy_match_equals_all_pairs(spark, rules, left, right):
    got = fuzzy_match(*sides(spark, left, right), rules).select("aid", "bid", "levenshtein_distance")
    want = [
        (i, j, distance(a.lower(), b.lower())) for i, a in enumerate(left) for j, b in enumerate(right) if close(a, b)
    ]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("rules", [Rules(), Rules(neighbour_cost=0.01, hot_bucket=20)])
def test_hundreds_of_names(spark, rules):
    """Names of several words, and their misspellings, against all pairs."""
    rng = random.Random(5)
    words = ["north", "south", "wind", "trade", "labs", "works", "Inc", "GmbH", "é", "of", "the", "12"]

    def misspelt(name):
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(name) + 1)
            name = rng.choice([name[:at] + rng.choice("aeB ") + name[at:], name[:at] + name[at + 1 :], name[:at] + "x" + name[at + 1 :]])
        return name

    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(150)]
    left, right = ([misspelt(rng.choice(base)) for _ in range(250)] for _ in range(2))
    got = fuzzy_match(*sides(spark, left, right), rules).select("aid", "bid", "levenshtein_distance").collect()
    known = {}
    for a in set(left):
        for b in set(right):
            if len(a) > 5 and len(b) > 5 and abs(len(a) - len(b)) <= 2 and (d := distance(a.lower(), b.lower())) <= 2:
                known[a, b] = d
    assert sorted(map(tuple, got)) == sorted((i, j, known[a, b]) for i, a in enumerate(left) for j, b in enumerate(right) if (a, b) in known)
    assert len(got) > 100


@pytest.mark.parametrize("threshold", [1, 3])
def test_other_thresholds(spark, threshold):
    left = ["abcdefghij", "abcdefgh", "xbcdefghij", "jihgfedcba"]
    right = ["abcdefghi", "abdefghijj", "abcdefghijklm", "zzzzzzzzzz", "bcdefghijx"]
    for cost in (1, 0):
        got = name_pairs(*sides(spark, left, right), Rules(threshold, 8, neighbour_cost=cost))
        want = {(a, b, distance(a, b)) for a in left for b in right if distance(a, b) <= threshold}
        assert {tuple(r) for r in got.collect()} == want


def test_min_length_must_leave_segments(spark):
    with pytest.raises(ValueError):
        name_pairs(*sides(spark, ["abcdef"], ["abcdef"]), Rules(threshold=3, min_length=6))


def test_names_sharing_their_only_segment_are_all_found(spark):
    """One prefix on every name: the segment is hot and the neighbourhoods take over."""
    left = [f"company number {i:05d}" for i in range(400)]
    right = [f"COMPANY NUMBER {i * 3:05d}" for i in range(150)]
    got = name_pairs(*sides(spark, left, right), Rules(hot_bucket=50, neighbour_cost=0.1)).count()
    assert got == sum(1 for a in left for b in right if distance(a, b.lower()) <= 2)


def test_giant_segment_with_few_partners(spark):
    """Many names share a segment with one name of the other side: joined in slices."""
    left = [f"warehouse {i:04d}" for i in range(300)]
    pairs = name_pairs(*sides(spark, left, ["Warehouse 0007", "other company"]), Rules(hot_bucket=20))
    assert {r.a for r in pairs.collect()} == {a for a in left if distance(a, "warehouse 0007") <= 2}


@pytest.mark.parametrize("rules", [Rules(), Rules(neighbour_cost=0)])
def test_keys_cut_from_names_are_not_broadcast(spark, tmp_path, rules):
    """Files of names are small, the keys cut from them many: the driver must not gather these."""
    for c in "ab":
        spark.range(200).select(F.format_string("%06d company", "id").alias("name"), "id").write.parquet(f"{tmp_path}/{c}")
    plan = name_pairs(*(Side(spark.read.parquet(f"{tmp_path}/{c}"), "id", "name") for c in "ab"), rules)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "Inner" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_guard_counts_the_original_length(spark):
    got = fuzzy_match(*sides(spark, ["Acme1", "Acme12", None], ["ACME12", "Acme1"]))
    assert [(r.aid, r.bid) for r in got.collect()] == [(1, 0)]


def test_cascade_by_rule(spark):
    left = [
        (1, "Northwind"), (2, "CONTOSO LTD"), (3, "Fabrikam Inc"), (4, "Tailspin"), (5, None), (None, "Northwind"),
        (6, "Fabrikam Inc"), (7, "Wingtip Toys"), (7, "Contoso Ltd"),
    ]
    right = [(10, "northwind"), (11, "Contoso Ltd"), (12, "Fabrikan Inc"), (13, "Fabrikam Incs"), (14, "Adatum"), (None, "Tailspim")]
    a, b = spark.createDataFrame(left, "aid int, an string"), spark.createDataFrame(right, "bid int, bn string")
    got = sorted(
        ((r.aid, r.an, r.bid, r.bn, r.match_quality) for r in match_cascade(Side(a, "aid", "an"), Side(b, "bid", "bn")).collect()),
        key=repr,
    )
    want = sorted([
        (1, "Northwind", 10, "northwind", 0), (None, "Northwind", 10, "northwind", 0),
        (2, "CONTOSO LTD", 11, "Contoso Ltd", 0), (7, "Contoso Ltd", 11, "Contoso Ltd", 0),
        (3, "Fabrikam Inc", 12, "Fabrikan Inc", 1), (6, "Fabrikam Inc", 12, "Fabrikan Inc", 1),
        (3, "Fabrikam Inc", 13, "Fabrikam Incs", 1), (6, "Fabrikam Inc", 13, "Fabrikam Incs", 1),
        (4, "Tailspin", None, "Tailspim", 1),
        # a NULL id never counts as matched; id 7 does, so its other row goes
        (None, None, None, "Tailspim", None), (None, "Northwind", None, None, None),
        (5, None, None, None, None), (None, None, 14, "Adatum", None),
    ], key=repr)
    assert got == want


@SLOW
@given(left=NAMES, right=NAMES)
def test_cascade_places_every_row_once(spark, left, right):
    a, b = sides(spark, left, right)
    found = match_cascade(a, b).collect()
    kind = {}
    for r in found:
        for side, id_, other in (("a", r.aid, r.bid), ("b", r.bid, r.aid)):
            if id_ is not None:
                kind.setdefault((side, id_), set()).add("exact" if r.match_quality == 0 else "close" if other is not None else "none")
    assert all(len(k) == 1 for k in kind.values())
    assert len(kind) == len(left) + len(right)
    assert {i for s, i in kind if s == "a" and kind[s, i] != {"exact"}} == {r.aid for r in unmatched(a, b).collect()}
    assert exact_match(a, b).count() == sum(r.match_quality == 0 for r in found)


def test_name_index_in_runs_equals_one_run(spark, rows):
    """Names that come in three runs, with dense segments among them, give the pairs of all at once."""
    rng = random.Random(3)
    alphabet = "abc"
    def name():
        head = rng.choice(["", "", "customer#00", "thegroup "])
        return head + "".join(rng.choice(alphabet) for _ in range(rng.randint(5, 9)))
    a, b = ([name() for _ in range(300)] + [None, "short", "SameName", "samename"] for _ in "ab")
    side = lambda names, c: match.Side(spark.createDataFrame(list(enumerate(names)), f"{c}_id long, {c}_name string"), f"{c}_id", f"{c}_name")
    want = rows(match.name_pairs(side(a, "a"), side(b, "b")))
    index = match.NameIndex(spark, scratch_path(spark, "names"))
    assert index.pairs().count() == 0
    for part in (slice(0, 100), slice(50, 200), slice(0, None)):
        index.add(side(a[part], "a"), side(b[part], "b"))
    assert rows(index.pairs()) == want and len(want) > 50
    assert index.add(side(a, "a"), side(b, "b")) == (0, 0) and rows(index.pairs()) == want
    both = match.match_cascade(side(a, "a"), side(b, "b"), index=index)
    assert rows(both) == rows(match.match_cascade(side(a, "a"), side(b, "b")))


def test_name_index_probes_new_names_only(spark, monkeypatch):
    """What is cut and compared grows with the increment, not with what is stored."""
    side = lambda first, n, c: match.Side(spark.range(first, first + n).select(F.col("id").alias(f"{c}_id"), F.substring(F.md5(F.col("id").cast("string")), 1, 14).alias(f"{c}_name")), f"{c}_id", f"{c}_name")
    index = match.NameIndex(spark, scratch_path(spark, "names"))
    assert index.add(side(0, 3000, "a"), side(2000, 3000, "b")) == (3000, 3000)
    probed, plain = [], match._close
    monkeypatch.setattr(match, "_close", lambda i, p, rules: probed.append((i.count(), p.select("b").distinct().count())) or plain(i, p, rules))
    assert index.add(side(2990, 20, "a"), side(4990, 20, "b")) == (10, 10)
    assert [p for _, p in probed] == [10, 10] and all(i < 300 for i, _ in probed)
    assert index.pairs().where("distance = 0").count() == 1010


def test_an_interrupted_run_of_the_name_index_is_done_again(spark, rows, monkeypatch):
    side = lambda names, c: match.Side(spark.createDataFrame(list(enumerate(names)), f"{c}_id long, {c}_name string"), f"{c}_id", f"{c}_name")
    index = match.NameIndex(spark, scratch_path(spark, "names"))
    with monkeypatch.context() as m:
        m.setattr(match, "_close", lambda *x: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.add(side(["alphabet"], "a"), side(["alphabets"], "b"))
    assert index.pairs().count() == 0
    assert index.add(side(["alphabet"], "a"), side(["alphabets"], "b")) == (1, 1)
    assert rows(index.pairs()) == [("alphabet", "alphabets", 1)]
