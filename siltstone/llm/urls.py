"""Verdicts on URLs: written rules first, mined association rules where none of these fits.

A URL is cut to tokens: its scheme, host labels, words of its path and of what follows, and the leading digit of
numbers in the path.  Labelled URLs are transactions of their frequent tokens and their label.  Spark's FP-growth
mines them, or, where a URL has too many frequent tokens for all their combinations, counts by the number of tokens;
combinations of tokens that imply a label with enough support and confidence are rules, unless a rule
with one token less implies it as surely.  Rules are indexed by their rarest token: a URL looks up its tokens,
verifies the rules found there, and takes the surest.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import table
from siltstone.sources.stage import stage


class Rule(NamedTuple):
    """Fits a host and its subdomains, where the path starts with `path`."""

    host: str
    path: str
    verdict: str


# The rules of the contract.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

VERDICTS = ("allow", "block")  # the first is that of URLs about which nothing is known

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Mining(NamedTuple):
    """Which rules to mine.  At most 100 / `percent` times the combinations of `longest` out of a URL's frequent tokens
    pass, so the rules have a bound that does not grow with the URLs."""

    least_rows: int = 5          # labelled URLs that a rule holds for, at least
    percent: int = 1             # and their share of all labelled ones
    least_confidence: float = 0.8
    most_items: int | None = None  # if given, only so many tokens of a URL, those whose shares differ most between the labels
    longest: int = 3             # tokens of a rule


#: Frequent tokens of a URL with which FP-growth, which knows no `longest`, goes through all combinations.
GROWN_ITEMS = 12
#: What the SQL takes of a URL's frequent tokens; the same rows wherever no URL has more.
_SQL_ITEMS = 12


# --- URLs


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def url_parts(url: Column) -> tuple[Column, Column, Column, Column]:
    """Scheme, host (A-Z lower-cased), path, and what follows it.  All are empty for null and without `://`."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    scheme = F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    tail = F.substring(rest, F.length(host) + F.length(path) + 1, F.length(rest))
    return _lower(scheme), _lower(host), path, tail


def url_tokens(scheme: Column, host: Column, path: Column, tail: Column) -> Column:
    """The different tokens of a URL, each with a mark of the part it comes from."""
    def marked(mark: str, words: Column) -> Column:
        return F.transform(words, lambda w: F.concat(F.lit(mark), w))

    words = lambda c: F.regexp_extract_all(_lower(c), F.lit(_WORDS), F.lit(0))
    numbers = F.filter(words(path), lambda w: w.rlike(r"^[0-9]+$"))
    return F.array_distinct(F.concat(
        F.when(scheme != "", F.array(F.concat(F.lit("s:"), scheme))).otherwise(F.array().cast("array<string>")),
        marked("h:", F.filter(F.split(host, r"\."), lambda w: w != "")), marked("p:", words(path)),
        F.transform(numbers, lambda w: F.concat(F.lit("#"), F.substring(w, 1, 1))), marked("q:", words(tail)),
    ))


def written_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The rule that fits as one struct of `rule` and `verdict`, or null.  The longest wins, then the one with
    the longer host.  Every rule is a branch of one expression, so this is for written lists, not for millions."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host))):  # the last is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


# --- mining


def _counted(transactions: DataFrame, least: int, mining: Mining) -> DataFrame:
    """Rules as FP-growth gives them, `longest` tokens at most, by counting all combinations of one token, of two, ..:
    of those only that grow out of a combination with enough URLs.  `transactions` have `tokens`, sorted, and `label`."""
    per_verdict = [F.count_if(F.col("label") == v).alias(v) for v in VERDICTS]
    grown, levels = transactions.select("label", F.array().cast("array<string>").alias("combined"), F.col("tokens").alias("after")), []
    for size in range(1, mining.longest + 1):
        places = F.sequence(F.lit(1), F.size("after"))
        grown = grown.where(F.size("after") > 0).select("label", "combined", "after", F.explode(places).alias("at")).select(
            "label", F.array_append("combined", F.element_at("after", F.col("at"))).alias("combined"),
            F.expr("slice(after, at + 1, size(after))").alias("after"),
        )
        enough = grown.groupBy("combined").agg(*per_verdict).where(F.greatest(*VERDICTS) >= least)
        levels.append(stage(enough, "combinations"))
        if size < mining.longest:
            grown = grown.join(levels[-1].select("combined"), "combined", "left_semi")
    both = None
    for level in levels:
        both = level if both is None else both.unionByName(level)
    each = both.select("combined", F.explode(F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(v).alias("n")) for v in VERDICTS])).alias("x"), (F.col(VERDICTS[0]) + F.col(VERDICTS[1])).alias("n_all"))
    each = each.select(F.col("combined").alias("tokens"), "x.verdict", "x.n", (F.col("x.n") / F.col("n_all")).alias("confidence"))
    return each.where((F.col("n") >= least) & (F.col("confidence") >= mining.least_confidence))


def mine(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Rules `tokens` (sorted), `key` (the rarest of them), `verdict`, `n` (URLs they hold for), `confidence` and
    `place` (1 for the first to take), from URLs with `tokens` and `label`, one of `VERDICTS`.

    The first is the surest, then the one that holds for more, the shorter, the smaller in text.  Without
    labelled URLs there are no rules; null labels do not count.  Runs jobs; the rules are written once.
    """
    spark = labelled.sparkSession
    labelled = stage(labelled.where(F.col("label").isin(*VERDICTS)).select(F.monotonically_increasing_id().alias("row"), "tokens", "label"), "labelled")
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return spark.createDataFrame([], "tokens array<string>, key string, verdict string, n long, confidence double, place int")
    least = max(mining.least_rows, -(-total * mining.percent // 100))
    allowed, blocked = (float(max(counts.get(v, 0), 1)) for v in VERDICTS)
    each = labelled.select("row", F.explode("tokens").alias("token"), "label")
    # no more than the tokens of a URL times 100 / percent
    frequent = stage(
        each.groupBy("token").agg(F.count("*").alias("n"), F.count_if(F.col("label") == VERDICTS[1]).alias("n_blocked")).where(F.col("n") >= least)
        .withColumn("differs", F.abs(F.col("n_blocked") / F.lit(blocked) - (F.col("n") - F.col("n_blocked")) / F.lit(allowed))),
        "frequent-tokens",
    )
    best = F.array_sort(F.collect_list(F.struct((-F.col("differs")).alias("order"), "token")))  # of one URL
    best = best if mining.most_items is None else F.slice(best, 1, mining.most_items)
    items = each.join(F.broadcast(frequent), "token").groupBy("row", "label").agg(best.alias("best"))
    transactions = stage(items.select(F.array_sort(F.col("best.token")).alias("tokens"), "label"), "transactions")
    # a URL without frequent tokens has no transaction, so the share is taken of those that have one
    found = transactions.agg(F.count("*").alias("n"), F.max(F.size("tokens")).alias("most")).first()
    n = found["n"]
    if not n:
        return mine(labelled.limit(0), mining)
    if found["most"] <= GROWN_ITEMS:
        grown = transactions.select(F.array_append("tokens", F.concat(F.lit("verdict="), "label")).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=min((least - 0.5) / n, 1.0), minConfidence=mining.least_confidence).fit(grown)
        verdict = F.col("consequent")[0]
        rules = model.associationRules.where(verdict.startswith("verdict=") & (F.size("antecedent") <= mining.longest)).select(
            F.array_sort("antecedent").alias("tokens"), F.substring_index(verdict, "=", -1).alias("verdict"), F.round(F.col("support") * n).cast("long").alias("n"), "confidence"
        )
    else:
        rules = _counted(transactions, least, mining)
    rules = stage(rules, "association-rules")
    shorter = rules.select(F.col("tokens").alias("fewer"), F.col("verdict").alias("same"), F.col("confidence").alias("as_sure"))
    implied = (
        rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("left_out")).withColumn("fewer", F.array_remove("tokens", F.col("left_out")))
        .join(shorter, ["fewer"]).where((F.col("verdict") == F.col("same")) & (F.col("as_sure") >= F.col("confidence"))).select("tokens", "verdict").distinct()
    )
    kept = rules.join(implied, ["tokens", "verdict"], "left_anti")
    keys = (
        kept.select("tokens", "verdict", F.explode("tokens").alias("token")).join(F.broadcast(frequent.withColumnRenamed("n", "n_token")), "token")
        .groupBy("tokens", "verdict").agg(F.min(F.struct("n_token", "token"))["token"].alias("key"))
    )
    order = Window.orderBy(F.desc("confidence"), F.desc("n"), F.size("tokens"), F.array_join("tokens", " "))  # of few rows, see Mining
    return stage(kept.join(keys, ["tokens", "verdict"]).withColumn("place", F.row_number().over(order)).select("tokens", "key", "verdict", "n", "confidence", "place"), "rules")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """`row` and `place` of the first rule that fits, for the URLs (`row`, `tokens`) that one fits."""
    index = rules.select(F.col("key").alias("token"), F.col("tokens").alias("needed"), "place")
    looked_up = urls.select("row", "tokens", F.explode("tokens").alias("token")).join(F.broadcast(index), "token")
    return looked_up.where(F.size(F.array_except("needed", "tokens")) == 0).groupBy("row").agg(F.min("place").alias("place"))


def url_verdicts(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None, mining: Mining = Mining(), page_id: str = "page_id", url: str = "url") -> DataFrame:
    """`page_id`, `host`, `path`, `rule` (the written rule that fits, else null), `mined` (the tokens of the mined
    rule, where no written one fits, else null) and `verdict`, for every row of `pages`.

    `labelled` has `url` and `label`, the URLs to learn from; by default these are the pages that written
    rules decide.  Where neither kind of rule fits, the verdict is `allow`.  Null urls and those without `://`
    have no host, path or tokens.  Repeated rows and null ids are kept; other columns are ignored.  Runs jobs.
    """
    def cut(df: DataFrame, column: str, *others: Column) -> DataFrame:
        scheme, host, path, tail = url_parts(F.col(f"`{column}`"))
        parts = df.select(*others, scheme.alias("scheme"), host.alias("host"), path.alias("path"), tail.alias("tail"))
        return parts.withColumn("tokens", url_tokens(*[F.col(c) for c in ("scheme", "host", "path", "tail")])).drop("scheme", "tail")

    found = cut(pages, url, F.col(f"`{page_id}`").alias("page_id")).withColumn("written", written_rule(F.col("host"), F.col("path"), rules))
    found = stage(found.withColumn("row", F.monotonically_increasing_id()), "urls")
    if labelled is None:
        learned = found.where("written is not null").select("tokens", F.col("written.verdict").alias("label"))
    else:
        learned = cut(labelled, "url", F.col("label"))
    mined = mine(learned, mining)
    best = matched(found.where("written is null").select("row", "tokens"), mined)
    best = best.join(F.broadcast(mined.select("place", F.array_join("tokens", " ").alias("mined"), F.col("verdict").alias("mined_verdict"))), "place").select("row", "mined", "mined_verdict")
    return found.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("written.rule").alias("rule"), "mined", F.coalesce("written.verdict", "mined_verdict", F.lit(VERDICTS[0])).alias("verdict")
    )


# --- query


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


def _sql() -> str:
    """The same in SQL, combinations of tokens by self-joins."""
    m = Mining()
    if m.longest != 3:
        raise ValueError("the joins below are for three tokens")
    lower = f"'{_UPPER}', '{_LOWER}'"
    ordered = sorted(RULES, key=lambda r: (len(r.host) + len(r.path), len(r.host)), reverse=True)
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.host + r.path}'" for r in ordered) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in ordered) + " END"
    words = lambda c: f"regexp_extract_all(translate({c}, {lower}), '{_WORDS}')"
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN translate(substr(url, 1, instr(url, '://') - 1), {lower}) ELSE '' END AS scheme,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, scheme, translate(regexp_extract(rest, '^[^/?#]*'), {lower}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(rest, '^[^?#]*', '') AS tail FROM cut
), u AS MATERIALIZED (
  SELECT page_id, host, path, {rule} AS rule, {verdict} AS written, list_distinct(
    CASE WHEN scheme = '' THEN [] ELSE ['s:' || scheme] END || list_transform(list_filter(string_split(host, '.'), lambda w: w <> ''), lambda w: 'h:' || w)
    || list_transform({words("path")}, lambda w: 'p:' || w) || list_transform(list_filter({words("path")}, lambda w: regexp_full_match(w, '[0-9]+')), lambda w: '#' || w[1])
    || list_transform({words("tail")}, lambda w: 'q:' || w)) AS tokens FROM parts
), size AS (
  SELECT greatest({m.least_rows}, (count(*) * {m.percent} + 99) // 100) AS least, greatest(count(*) FILTER (written = 'block'), 1)::DOUBLE AS blocked,
    greatest(count(*) FILTER (written = 'allow'), 1)::DOUBLE AS allowed FROM u WHERE written IS NOT NULL
), each AS (SELECT page_id, written, unnest(tokens) AS token FROM u WHERE written IS NOT NULL),
frequent AS (
  SELECT token, count(*) AS n, abs(count(*) FILTER (written = 'block') / blocked - count(*) FILTER (written <> 'block') / allowed) AS differs
  FROM each, size GROUP BY token, blocked, allowed, least HAVING count(*) >= least
), items AS MATERIALIZED (
  SELECT page_id, written, token FROM each JOIN frequent USING (token)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY differs DESC, token) <= {_SQL_ITEMS}
), combined AS (
  SELECT [token] AS tokens, written FROM items
  UNION ALL SELECT [a.token, b.token], a.written FROM items a JOIN items b ON a.page_id = b.page_id AND a.token < b.token
  UNION ALL SELECT [a.token, b.token, c.token], a.written FROM items a JOIN items b ON a.page_id = b.page_id AND a.token < b.token
    JOIN items c ON a.page_id = c.page_id AND b.token < c.token
), counted AS (SELECT tokens, written AS verdict, count(*) AS n, sum(count(*)) OVER (PARTITION BY tokens) AS n_all FROM combined GROUP BY tokens, written),
sure AS MATERIALIZED (SELECT tokens, verdict, n, n::DOUBLE / n_all::DOUBLE AS confidence FROM counted, size WHERE n >= least AND n::DOUBLE / n_all::DOUBLE >= {m.least_confidence}),
implied AS (
  SELECT DISTINCT r.tokens, r.verdict FROM (SELECT *, unnest(tokens) AS left_out FROM sure) r
  JOIN sure s ON s.tokens = list_filter(r.tokens, lambda t: t <> r.left_out) AND s.verdict = r.verdict AND s.confidence >= r.confidence
), rules AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY confidence DESC, n DESC, len(tokens), array_to_string(tokens, ' ')) AS place FROM sure ANTI JOIN implied USING (tokens, verdict)
), best AS (SELECT page_id, min(place) AS place FROM u JOIN rules r ON list_has_all(u.tokens, r.tokens) WHERE written IS NULL GROUP BY page_id)
SELECT page_id, host, path, rule, array_to_string(r.tokens, ' ') AS mined, coalesce(written, r.verdict, '{VERDICTS[0]}') AS verdict
FROM u LEFT JOIN best USING (page_id) LEFT JOIN rules r USING (place)
"""


OP12_SQL = _sql()
