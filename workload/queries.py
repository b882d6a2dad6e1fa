"""One query per operator, over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.functions.columns import bool_text, hashed_id, joined_text, parse_bool, sentinel_to_null, surrogate_key, survivorship
from siltstone.functions.udf import map_parser, parse_distinct
from siltstone.operators import match
from siltstone.operators.bridge import AddressDictionary, address_bridge, address_table
from siltstone.operators.cdc import scd1_batch
from siltstone.operators.hierarchy import Hierarchy, attach_owner, hierarchy_rollup, resolved_owner
from siltstone.operators.joins import dimension_join, parent_lookup, salted_join
from siltstone.operators.project import normalize_headers, project, sql_over, to_contract
from siltstone.plans import raw
from siltstone.plans.curated import Curated
from siltstone.plans.pipeline import build_curated, load_batch, load_erp
from siltstone.sources.stage import scratch_path
from siltstone.sources.tables import materialize, read_table
from siltstone.streaming.ingest import LandingTable, csv_stream
from siltstone.streaming.upsert import LatestTable
from workload.landing import LANDING, landed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


# --- scans, projections, predicates ----------------------------------------------------------------


def scan_project(spark, d):
    return project(table(spark, d, "lineitem"), """
        l_orderkey -> order_id
        l_linenumber -> line
        l_returnflag -> return_flag
    """)


def typed_projection(spark, d):
    """Casts from text, with malformed and overflowing values."""
    key = F.col("o_orderkey")
    text = table(spark, d, "orders").select(
        key.alias("OrderKey"),
        F.when(key % 10 == 3, "n/a").when(key % 10 == 4, "123456789012.5").otherwise(F.concat(key.cast("string"), F.lit(".25"))).alias("Amount"),
        F.when(key % 7 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("CloseDate"),
        F.when(key % 5 == 0, "maybe").when(key % 2 == 0, "true").otherwise("false").alias("IsClosed"),
        F.when(key % 9 == 1, "one").otherwise((key % 100).cast("string")).alias("Rank__c"),
    )
    typed = project(text, """
        OrderKey
        Amount : decimal(10,2)
        CloseDate : date
        IsClosed : boolean
        Rank__c : int -> rank
    """)
    return typed.withColumn("close_date", F.col("close_date").cast("string"))


def normalize_headers_(spark, d):
    shouting = table(spark, d, "part").select(F.col("p_partkey").alias("P_PartKey"), F.col("p_brand").alias("P_BRAND"))
    return normalize_headers(shouting).select("p_partkey", "p_brand")


def rename_drop_star(spark, d):
    part = table(spark, d, "part").drop("p_retailprice", "p_type").withColumnRenamed("p_name", "part_name")
    return part.select(F.upper("p_brand").alias("brand_code"), "*")


def sentinel_to_null_(spark, d):
    return table(spark, d, "orders").select("o_orderkey", sentinel_to_null("o_orderpriority", "4-NOT SPECIFIED").alias("priority"))


def null_split(spark, d):
    """Rows without and with a parent, filtered apart and tagged."""
    orders = table(spark, d, "orders").select("o_orderkey", sentinel_to_null("o_orderpriority", "5-LOW").alias("parent_id"))
    return (
        orders.filter("parent_id is null").withColumn("part", F.lit("top"))
        .unionByName(orders.filter("parent_id is not null").withColumn("part", F.lit("child")))
    )


def predicate_mix(spark, d):
    parts = table(spark, d, "part").where(
        F.col("p_brand").isin("Brand#1", "Brand#12", "Brand#17", "Brand#23", "Brand#4") & ~F.col("p_size").isin(1, 2, 3)
        & ~F.col("p_name").like("small%")
        & ((F.col("p_type") != "ECONOMY") | ((F.col("p_size") > 20) & F.col("p_name").isNotNull()))
    )
    lines = table(spark, d, "lineitem").where((F.col("l_discount") <= 0.05) & (F.col("l_returnflag") != "R"))
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        "l_orderkey", "l_linenumber", "p_partkey", "p_brand", "p_size"
    )


def tagged_union(spark, d):
    return (
        table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("identifier"))
        .unionByName(table(spark, d, "supplier").select(
            F.col("s_name").alias("name"), F.lit("supplier").alias("identifier"), F.lit(None).alias("segment")))
        .unionByName(table(spark, d, "part").select(
            F.col("p_name").alias("name"), F.col("p_size").alias("size"), F.lit("part").alias("identifier")), allowMissingColumns=True)
    )


def union_distinct(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"), (F.col("c_custkey") % 10).alias("digit")).union(
        table(spark, d, "supplier").select("s_nationkey", F.col("s_suppkey") % 10)
    ).distinct()


def ordered_output(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        F.desc("o_orderpriority"), "o_totalprice", "o_orderkey"
    )


def address_concat(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    rows = dimension_join(table(spark, d, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), places, "n_nationkey")
    segment = sentinel_to_null("c_mktsegment", "BUILDING")
    nation_name = F.when(F.col("c_custkey") % 3 > 0, F.col("n_name"))
    return rows.select("c_custkey", joined_text(segment, nation_name, F.when(F.col("c_custkey") % 2 > 0, F.col("r_name"))).alias("clean_address"))


def parse_bool_(spark, d):
    text = table(spark, d, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, F.element_at(F.array(F.lit("true"), F.lit("T"), F.lit("1")), (F.col("doc_id") % 3 + 1).cast("int")))
        .otherwise(F.element_at(F.array(F.lit("False"), F.lit("f"), F.lit("0")), (F.col("doc_id") % 3 + 1).cast("int"))).alias("quality"),
        F.when(F.col("toxic") == 1, "yes").when(F.col("doc_id") % 2 == 0, " false").otherwise("f").alias("toxic"),
        (F.col("quality") + F.col("doc_id") % 2).alias("number"),
    )
    return text.select(
        "doc_id", parse_bool("quality").alias("quality"), parse_bool("toxic", strict=False).alias("toxic"),
        bool_text(parse_bool("toxic", strict=False)).alias("toxic_text"), bool_text(parse_bool("quality")).alias("quality_text"),
        bool_text("number").alias("number_text"),
    )


def decimal_ratio(spark, d):
    percent = (F.col("l_discount") * 100).cast("decimal(5,2)")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (percent / 100).alias("fraction"))


def surrogate_keys(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    merged = c.join(s, F.col("c_custkey") == F.col("s_suppkey") * 2, "full")
    return merged.select(
        "c_custkey", "s_suppkey", hashed_id("s_suppkey").alias("hashed"),
        surrogate_key(F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")), hashed="c_custkey").alias("key"),
    )


def _split_name(text: str) -> dict[str, str]:
    size, noun = text.split(" ")
    if size == "old":
        raise ValueError("no parse")
    return {"size": size, "noun": noun}


def map_extract(spark, d):
    part = table(spark, d, "part")
    parsed = parse_distinct(part, "p_name", map_parser(_split_name, "noun", (ValueError,)), ["size", "noun", "colour"])
    return part.select("p_partkey", "p_name").join(parsed, "p_name", "left")  # a NULL text stays


# --- datasets: declaration, contract, SQL, sinks ----------------------------------------------------

CUSTOMER_CONTRACT = """
    name STRING COMMENT 'Full name',
    customer_id BIGINT,
    nation BIGINT COMMENT 'Widened from INT',
    balance DOUBLE,
    closed_date DATE
"""


def schema_contract(spark, d):
    rows = project(table(spark, d, "customer"), """
        c_custkey -> customer_id
        c_nationkey -> nation
        c_acctbal -> balance
        c_name -> name
    """)
    return to_contract(rows, CUSTOMER_CONTRACT)


def view_reuse(spark, d):
    """One view with two consumers, one of which reads the other."""
    def in_debt() -> DataFrame:
        return table(spark, d, "customer").where("c_acctbal < 1000")

    def by_nation(view: DataFrame) -> DataFrame:
        return view.groupBy("c_nationkey").agg(F.count("*").alias("n_customers"))

    view = in_debt()
    return view.join(by_nation(view), "c_nationkey").select("c_custkey", "c_nationkey", "n_customers")


def sql_over_dataframes(spark, d):
    return sql_over("""
        SELECT o.o_orderkey, c.c_name, "web" AS identifier -- literal tag
        FROM {orders} o LEFT JOIN {customer} c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderstatus IN ('F', 'O') AND o.o_orderpriority NOT LIKE '5%';
    """, orders=table(spark, d, "orders"), customer=table(spark, d, "customer"))


def materialize_roundtrip(spark, d):
    rows = table(spark, d, "supplier").withColumnRenamed("s_suppkey", "supplier_id")
    name = f"supplier_{scratch_path(spark, '').rsplit('-', 1)[1]}"
    return materialize(
        rows, scratch_path(spark, "supplier"), name=name, quality="curated", description="Suppliers, as they are",
    )


def materialize_ranges(spark, d):
    """Orders stored in ranges of their priority and price, twice; the second version is read by its path."""
    path, orders = scratch_path(spark, "orders"), table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    for rows in (orders.where("o_orderkey % 2 = 0"), orders):
        materialize(rows, path, order_by=[F.desc("o_orderpriority"), "o_totalprice"])
    return read_table(spark, path)


def _orders_as_csv(orders: DataFrame, path: str) -> None:
    orders.select(
        F.col("o_orderkey").alias("OrderKey"), F.col("o_totalprice").alias("CF$_KW"), F.col("o_orderpriority").alias("PRIORITY"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("CREATION_DATE"),
    ).write.mode("append").option("header", True).csv(path)


ORDER_FILE = """
    OrderKey : bigint
    CF$_KW : double
    PRIORITY : string
    CREATION_DATE : timestamp
"""


def ingest_csv_stream(spark, d):
    """Orders dropped as CSV files, read once each by a stream; the second run finds nothing new."""
    drop = scratch_path(spark, "orders-csv")
    _orders_as_csv(table(spark, d, "orders"), drop)
    landing = LandingTable(spark, scratch_path(spark, "orders"))
    for _ in range(2):
        landing.run(project(csv_stream(spark, drop), ORDER_FILE))
    return landing.read().withColumn("creation_date", F.col("creation_date").cast("string"))


def ingest_archived(spark, d):
    """As ``ingest_csv_stream``, in three drops; each run moves the files of the one before to an archive."""
    drop, archive = scratch_path(spark, "orders-csv"), scratch_path(spark, "orders-archive")
    orders, landing = table(spark, d, "orders"), LandingTable(spark, scratch_path(spark, "orders"))
    for status in "FOP":
        _orders_as_csv(orders.where(F.col("o_orderstatus") == status), drop)
        landing.run(project(csv_stream(spark, drop, archive=archive), ORDER_FILE))
    return landing.read().withColumn("creation_date", F.col("creation_date").cast("string"))


def csv_rejects(spark, d):
    """Orders as CSV files in which a tenth of the rows lacks a field and a tenth has one too many: good rows land
    typed, the others whole among the rejects."""
    drop, fields_ = scratch_path(spark, "orders-csv"), ["OrderKey", "CF$_KW", "PRIORITY"]
    cells = [F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.col("o_orderpriority")]
    last = F.col("o_orderkey") % 10
    line = F.when(last == 3, F.concat_ws(",", *cells[:2])).when(last == 7, F.concat_ws(",", *cells, F.lit("more"))).otherwise(F.concat_ws(",", *cells))
    # a separator that no line has, so that lines are written as they are
    table(spark, d, "orders").select(line.alias(",".join(fields_))).write.option("header", True).option("sep", "\u0001").csv(drop)
    stream = csv_stream(spark, drop, ", ".join(f"`{c}` string" for c in fields_), keep_malformed=True)
    landing = LandingTable(spark, scratch_path(spark, "orders")).run(project(stream, "OrderKey : bigint\nCF$_KW : double\nPRIORITY : string"))
    return landing.read().unionByName(landing.rejects().select("row"), allowMissingColumns=True)


def refresh_full_vs_incremental(spark, d):
    """Two file drops: an incremental run after each, against one full refresh at the end."""
    drop, orders = scratch_path(spark, "orders-csv"), table(spark, d, "orders")
    landing = LandingTable(spark, scratch_path(spark, "orders"))
    for status in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        _orders_as_csv(orders.where(status), drop)
        landing.run(project(csv_stream(spark, drop), ORDER_FILE))
    incremental = landing.read().withColumn("mode", F.lit("incremental"))
    refreshed = landing.run(project(csv_stream(spark, drop), ORDER_FILE), full_refresh=True).read()
    both = incremental.unionByName(refreshed.withColumn("mode", F.lit("full")))
    return both.drop("creation_date")


# --- joins ------------------------------------------------------------------------------------------


def broadcast_left(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_name").where("n_nationkey <> 7")
    return dimension_join(table(spark, d, "supplier").withColumnRenamed("s_nationkey", "n_nationkey"), nation, "n_nationkey").select(
        "s_suppkey", "n_nationkey", "n_name")


def left_lookup(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation").where("n_regionkey <> 2")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select("c_custkey", "n_name")


def _turns(spark, d) -> DataFrame:
    key = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    return table(spark, d, "conversations").select(
        key(F.col("turn")).alias("node"), key(F.col("turn") - 1).alias("parent"), "role", F.length("text").alias("size"), "turn",
    )


def manager_lookup(spark, d):
    return parent_lookup(_turns(spark, d), "parent", "node", {"role": "parent_role"}).alias("a").select("a.node", "a.role", "a.parent_role")


TURNS = Hierarchy("node", "parent", "role", "role", "user")


def hierarchy_lookup(spark, d):
    turns = _turns(spark, d)
    code, name = resolved_owner(TURNS)
    return attach_owner(turns, turns, TURNS).select(
        "node", "parent_level", "copies", code.alias("owner"), name.alias("owner_name"))


def hierarchy_rollup_(spark, d):
    turns = _turns(spark, d)
    nodes = turns.unionByName(turns.where("turn = 0"))  # repeated codes multiply the measures
    code, _ = resolved_owner(TURNS)
    rolled = hierarchy_rollup(turns.where("role <> 'system'"), nodes, TURNS, ["node", "role", "parent"], "size", "node", "total", "n")
    return rolled.select("node", "role", "parent_name", "total", "n", code.alias("owner"))


def left_where_vs_on(spark, d):
    """A right-side predicate after a left join drops unmatched rows; the same predicate in ON keeps them."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    on = o["o_custkey"] == c["c_custkey"]
    where = o.join(c, on, "left").where("c_mktsegment = 'BUILDING'")
    in_on = o.join(c, on & (c["c_mktsegment"] == "BUILDING"), "left")
    return where.select("o_orderkey", "c_name", F.lit("where").alias("form")).unionByName(
        in_on.select("o_orderkey", "c_name", F.lit("on").alias("form")))


def inner_filtered(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    joined = o.join(c, o["o_custkey"] == c["c_custkey"])
    return joined.where("o_orderstatus IN ('F', 'P') AND c_mktsegment NOT IN ('BUILDING')").select("o_orderkey", "c_custkey", "c_mktsegment")


def team_member_join(spark, d):
    l, o, c, n = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation"))
    return (
        l.join(o, l["l_orderkey"] == o["o_orderkey"]).join(c, o["o_custkey"] == c["c_custkey"])
        .join(n, c["c_nationkey"] == n["n_nationkey"])
        .select("l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority", "c_name", "n_name")
    )


def _urgent(spark, d) -> DataFrame:
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'")
    counted = urgent.groupBy(F.when(F.col("o_custkey") % 17 > 0, F.col("o_custkey")).alias("order_cust"), "o_orderstatus").agg(F.count("*").alias("n"))
    return counted.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))


def outer_three_valued(spark, d):
    customers = table(spark, d, "customer").select(
        F.when(F.col("c_custkey") % 13 > 0, F.col("c_custkey")).alias("cust"), "c_name")
    joined = salted_join(customers, _urgent(spark, d), "cust", "order_cust", "full")
    kept = joined.where(~(F.col("cust").isNull() & F.col("order_cust").isNotNull() & (F.col("status") == "F")))
    return kept.select("cust", "c_name", "order_cust", "status", "n")


def survivorship_outer(spark, d):
    c = table(spark, d, "customer").groupBy(F.floor(F.col("c_custkey") / 2).alias("slot")).agg(
        F.max("c_name").alias("name"), F.count("*").alias("n_customers"))
    s = table(spark, d, "supplier").groupBy((F.col("s_suppkey") * 3).cast("bigint").alias("slot")).agg(
        F.max("s_name").alias("supplier_name"), F.count("*").alias("n_suppliers"))
    return survivorship(c.join(s, "slot", "outer"), {"name": ["name", "supplier_name"]})


# --- matching ---------------------------------------------------------------------------------------


def _sides(spark, d) -> tuple[match.Side, match.Side]:
    right = table(spark, d, "supplier").select("s_suppkey", F.concat(
        F.when(F.col("s_suppkey") % 10 == 9, "WHOLESALE#").otherwise("CUSTOMER#"),
        F.lpad((F.col("s_suppkey") * 37).cast("string"), 9, "0"),
    ).alias("b_name"))
    left = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return match.Side(left, "c_custkey", "c_name"), match.Side(right, "s_suppkey", "b_name")


def exact_match(spark, d):
    return match.exact_match(*_sides(spark, d)).withColumn("match_quality", F.lit(0))


def unmatched_left(spark, d):
    return match.unmatched(*_sides(spark, d))


def unmatched_right(spark, d):
    left, right = _sides(spark, d)
    return match.unmatched(right, left)


def fuzzy_match_blocked(spark, d):
    left, right = _sides(spark, d)
    return match.fuzzy_match(left.with_rows(match.unmatched(left, right)), right.with_rows(match.unmatched(right, left)))


def match_cascade(spark, d):
    return match.match_cascade(*_sides(spark, d)).drop("levenshtein_distance")


def match_cascade_incremental(spark, d):
    """The cascade over a name index that has met half of either side's rows before."""
    left, right = _sides(spark, d)
    index = match.NameIndex(spark, scratch_path(spark, "names"))
    index.add(left.with_rows(left.rows.where("c_custkey % 2 = 0")), right.with_rows(right.rows.where("s_suppkey % 2 = 1")))
    return match.match_cascade(left, right, index=index).drop("levenshtein_distance")


def _streets(spark, d) -> tuple[DataFrame, DataFrame]:
    """Addresses of customers and suppliers in two spellings."""
    left = landed(spark, d, "erp_location_party_address_pub").select(
        "location_id", joined_text("address1", "city", sentinel_to_null("state"), "zip_code", "country_code").alias("clean_address"))
    sites, states = landed(spark, d, "control_sites"), landed(spark, d, "control_states")
    right = sites.join(states, sites["SiteStateId"] == states["stateid"], "left").select(
        F.col("SiteId").alias("site_id"), joined_text("SiteAddress1", "SiteCity", "stateabbreviation", "SiteZip").alias("clean_address"))
    return left, right


def address_standardize(spark, d):
    return address_table("clean_address", *_streets(spark, d))


def address_dictionary(spark, d):
    """The address table out of a dictionary that has met the addresses of one side before."""
    left, right = _streets(spark, d)
    known = AddressDictionary(spark, scratch_path(spark, "addresses"))
    known.add(left)
    return known.of(left, right)


def address_bridge_(spark, d):
    return address_bridge(*_streets(spark, d), "clean_address")


# --- change capture ---------------------------------------------------------------------------------


def scd1_batch_(spark, d):
    return scd1_batch(table(spark, d, "events").drop("ts"), ["user_id"], F.col("event_id") * 7919 % 1000003)


def scd1_stream(spark, d):
    """Person records as CSV change files, landed by one stream and upserted by the next."""
    drop = scratch_path(spark, "persons-csv")
    persons = landed(spark, d, "erp_company_person")
    landing = LandingTable(spark, scratch_path(spark, "company_person"))
    latest = LatestTable(spark, scratch_path(spark, "company_person_last_change"), ["_obj_id"], "_obj_version")
    # later versions arrive first
    late = F.col("OBJVERSION") < "000000000500"
    for rows in (persons.where(~late), persons.where(late)):
        rows.write.mode("append").option("header", True).csv(drop)
        landing.run(raw.raw_table("erp", "company_person", csv_stream(spark, drop)))
        latest.run(raw.company_person_changes(landing.read_stream()))
    return latest.read()


# --- whole datasets ---------------------------------------------------------------------------------


class RawTables(dict):
    """Raw tables over the derived landed ones, read as batches and built when first asked for."""

    SOURCES = {
        f"{name.split('_', 1)[0]}.{raw.SYSTEMS[name.split('_', 1)[0]][name.split('_', 1)[1]][0]}": name for name in LANDING
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, key: str) -> DataFrame:
        if key == "erp.company_person_last_change":
            changes = raw.company_person_changes(self["erp.company_person"])
            df = scd1_batch(changes, ["_obj_id"], "_obj_version")
        elif key.startswith("landing."):
            df = landed(self.spark, self.sf_dir, key.replace("landing.", "crm_"))
        else:
            name = self.SOURCES[key]
            df = raw.raw_table(*name.split("_", 1), landed(self.spark, self.sf_dir, name))
        self[key] = df
        return df


def _as_text(df: DataFrame) -> DataFrame:
    """Dates and times as text, which both engines print alike."""
    def shown(name: str, type_: str) -> Column:
        c = F.col(f"`{name}`")
        return c.cast("string").alias(name) if type_ in ("date", "timestamp", "timestamp_ntz") else c
    return df.select(*[shown(n, t) for n, t in df.dtypes])


def curated_query(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _as_text(getattr(Curated(RawTables(spark, sf_dir)), name))
    return query


def site_from_files(spark, d):
    """Sites all the way: CSV drops in two batches, streams, raw tables, stored curated tables."""
    landing, out = scratch_path(spark, "erp-landing"), scratch_path(spark, "warehouse")
    for even in (0, 1):
        for name in ("equipment_functional_cfv", "location_party_address_pub"):
            _drop_files(spark, d, landing, name, even)
        erp = load_erp(spark, landing, f"{out}/erp")
    control = load_batch("control", {n: landed(spark, d, f"control_{n}") for n in ("sites", "states")}, f"{out}/control")
    return _as_text(build_curated(erp | control, f"{out}/curated", ["site"]).site)


def _drop_files(spark: SparkSession, sf_dir: str, landing: str, name: str, even: int) -> None:
    """Half of a landed ERP table as CSV files."""
    rows = landed(spark, sf_dir, f"erp_{name}")
    half = rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == even)
    half.write.mode("append").options(header=True, ignoreTrailingWhiteSpace=False).csv(f"{landing}/{name}")


def erp_stream(name: str):
    """A raw ERP table from two file drops, each drained by a run of its stream."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        landing, out = scratch_path(spark, "erp-landing"), scratch_path(spark, "erp")
        for even in (0, 1):
            _drop_files(spark, sf_dir, landing, name, even)
            tables = load_erp(spark, landing, out)
        return _as_text(tables[f"erp.{name}"])
    return query


def raw_query(landed_name: str):
    system, source = landed_name.split("_", 1)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _as_text(raw.raw_table(system, source, landed(spark, sf_dir, landed_name)))
    return query


QUERIES = {
    "scan_project": scan_project,
    "typed_projection": typed_projection,
    "ingest_csv_stream": ingest_csv_stream,
    "ingest_archived": ingest_archived,
    "csv_rejects": csv_rejects,
    "refresh_full_vs_incremental": refresh_full_vs_incremental,
    "materialize_roundtrip": materialize_roundtrip,
    "materialize_ranges": materialize_ranges,
    "view_reuse": view_reuse,
    "schema_contract": lambda spark, d: _as_text(schema_contract(spark, d)),
    "sql_over_dataframes": sql_over_dataframes,
    "normalize_headers": normalize_headers_,
    "rename_drop_star": rename_drop_star,
    "sentinel_to_null": sentinel_to_null_,
    "tagged_union": tagged_union,
    "null_split": null_split,
    "predicate_mix": predicate_mix,
    "broadcast_left": broadcast_left,
    "left_lookup": left_lookup,
    "manager_lookup": manager_lookup,
    "hierarchy_lookup": hierarchy_lookup,
    "hierarchy_rollup": hierarchy_rollup_,
    "left_where_vs_on": left_where_vs_on,
    "inner_filtered": inner_filtered,
    "team_member_join": team_member_join,
    "outer_three_valued": outer_three_valued,
    "survivorship_outer": survivorship_outer,
    "exact_match": exact_match,
    "unmatched_left": unmatched_left,
    "unmatched_right": unmatched_right,
    "fuzzy_match_blocked": fuzzy_match_blocked,
    "match_cascade": match_cascade,
    "match_cascade_incremental": match_cascade_incremental,
    "surrogate_keys": surrogate_keys,
    "union_distinct": union_distinct,
    "ordered_output": ordered_output,
    "address_concat": address_concat,
    "address_standardize": address_standardize,
    "address_dictionary": address_dictionary,
    "address_bridge": address_bridge_,
    "map_extract": map_extract,
    "parse_bool": parse_bool_,
    "decimal_ratio": decimal_ratio,
    "scd1_batch": scd1_batch_,
    "scd1_stream": scd1_stream,
    "curated_employee": curated_query("employee"),
    **{f"curated_{name}": curated_query(name) for name in (
        "account", "customer", "equipment", "location", "site", "opportunity", "opportunity_team_member",
        "remaining_accounts", "opco_sites", "users", "erp_customers", "control_customers", "crm_accounts", "top_accounts", "exact_matches",
        "unmatched_accounts", "unmatched_control_customers", "close_matches", "remaining_control_customers", "matched_accounts",
        "erp_locations", "control_sites", "control_generators", "ps_generators", "erg_generators", "ps_sites", "pre_erp_sites",
    )},
    "site_from_files": site_from_files,
    **{f"raw_{name}": raw_query(name) for name in LANDING},
    **{f"stream_erp_{name}": erp_stream(name) for name in raw.ERP},
}
