"""US postal address standardisation as column expressions.

The input is address parts joined by commas, as ``joined_text`` makes them.  The result has the columns
of ``COLUMNS``.  Variants of one address (case, blanks, ``Street`` and ``St.``, full and short state,
ZIP and ZIP+4, with and without the country) give equal ``mapped_address`` values, and standardising a
``mapped_address`` again changes nothing.  Text without a house number or post-office box, or without a
ZIP code, is not taken for an address: it is kept whole in ``address_line_1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

COLUMNS = ("address_line_1", "address_line_2", "city", "state", "postal_code", "mapped_address")

# Postal abbreviations (states with territories and military codes), each followed by the spellings it replaces.
STREET_WORDS = """
ALY ALLEY
AVE AVENUE AV
BLVD BOULEVARD BOUL
BR BRANCH
BRG BRIDGE
BYP BYPASS
CIR CIRCLE CIRC
CT COURT
CTR CENTER CENTRE
CV COVE
DR DRIVE DRV
EST ESTATE
EXPY EXPRESSWAY EXPWY
EXT EXTENSION
FRK FORK
FWY FREEWAY
GRV GROVE
HTS HEIGHTS
HWY HIGHWAY HIWAY
JCT JUNCTION
LN LANE
LNDG LANDING
LOOP LOOPS
MDWS MEADOWS
MNR MANOR
PARK PARKS
PKWY PARKWAY PARKWY PKY
PL PLACE
PLZ PLAZA
PT POINT
RD ROAD
RDG RIDGE
RTE ROUTE
SQ SQUARE
ST STREET STR
STA STATION
TER TERRACE TERR
TPKE TURNPIKE
TRL TRAIL
VLG VILLAGE
VLY VALLEY
VW VIEW
XING CROSSING
N NORTH
S SOUTH
E EAST
W WEST
NE NORTHEAST
NW NORTHWEST
SE SOUTHEAST
SW SOUTHWEST
"""
UNIT_WORDS = """
APT APARTMENT
BLDG BUILDING
DEPT DEPARTMENT
FL FLOOR
LOT LOTS
RM ROOM
SPC SPACE
STE SUITE
TRLR TRAILER
UNIT UNITS
"""
STATES = """
AL ALABAMA
AK ALASKA
AZ ARIZONA
AR ARKANSAS
CA CALIFORNIA
CO COLORADO
CT CONNECTICUT
DE DELAWARE
DC DISTRICT OF COLUMBIA
FL FLORIDA
GA GEORGIA
HI HAWAII
ID IDAHO
IL ILLINOIS
IN INDIANA
IA IOWA
KS KANSAS
KY KENTUCKY
LA LOUISIANA
ME MAINE
MD MARYLAND
MA MASSACHUSETTS
MI MICHIGAN
MN MINNESOTA
MS MISSISSIPPI
MO MISSOURI
MT MONTANA
NE NEBRASKA
NV NEVADA
NH NEW HAMPSHIRE
NJ NEW JERSEY
NM NEW MEXICO
NY NEW YORK
NC NORTH CAROLINA
ND NORTH DAKOTA
OH OHIO
OK OKLAHOMA
OR OREGON
PA PENNSYLVANIA
RI RHODE ISLAND
SC SOUTH CAROLINA
SD SOUTH DAKOTA
TN TENNESSEE
TX TEXAS
UT UTAH
VT VERMONT
VA VIRGINIA
WA WASHINGTON
WV WEST VIRGINIA
WI WISCONSIN
WY WYOMING
AS AMERICAN SAMOA
GU GUAM
MP NORTHERN MARIANA ISLANDS
PR PUERTO RICO
VI VIRGIN ISLANDS
AA ARMED FORCES AMERICAS
AE ARMED FORCES EUROPE
AP ARMED FORCES PACIFIC
"""
COUNTRIES = ("US", "USA", "UNITED STATES", "UNITED STATES OF AMERICA")
ZIP = "(?:^| )([0-9]{5})(?:-?[0-9]{4})?$"
# house number, post-office box, or military box; then something
STREET_START = "^([0-9]+[A-Z]?(-[0-9]+)?|PO BOX|(PSC|CMR|UNIT) [0-9]+ BOX) +[^ ]"
POST_BOX = "(^|[ ,])(P ?O|POST OFFICE) BOX "


def abbreviations(table: str) -> dict[str, str]:
    """Spelling to abbreviation, for tables of one-word spellings."""
    return {word: line.split()[0] for line in table.strip().splitlines() for word in line.split()[1:]}


def state_codes() -> dict[str, str]:
    """State name or code to code."""
    pairs = [line.split(" ", 1) for line in STATES.strip().splitlines()]
    return {key: code for code, name in pairs for key in (code, name)}


_UNITS = "|".join(w for line in UNIT_WORDS.strip().splitlines() for w in line.split())
UNIT_START = f"^({_UNITS}) "
# a unit word right after the house number is the name of the street
UNIT_SPLIT = f"^([^ ]+ .*?[^ ]|[^ ]+ [^ ]) ({_UNITS}) (.+)$"
UNIT_NUMBER = f"(^|[ ,])({_UNITS}) ?# ?"


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _words(text: Column, table: dict[str, str]) -> Column:
    mapping = _lookup(table)
    return F.array_join(F.transform(F.split(text, " "), lambda w: F.coalesce(F.try_element_at(mapping, w), w)), " ")


def standardize(df: DataFrame, address: str) -> DataFrame:
    """Add the ``COLUMNS`` for the text column ``address``; the frame must have none of them yet."""
    c, keep = F.col, [f"`{name}`" for name in df.columns]
    last = F.try_element_at(c("__parts"), F.lit(-1))
    rest = F.slice(c("__parts"), F.lit(1), F.greatest(F.size("__parts") - 1, F.lit(0)))

    text = F.upper(F.trim(F.regexp_replace(F.regexp_replace(address, "[.]", ""), "[ \t\r\n]+", " ")))
    text = F.regexp_replace(text, UNIT_NUMBER, "$1$2 ")
    text = F.regexp_replace(text, "# ?", "UNIT ")
    text = F.regexp_replace(text, "UNIT UNIT ", "UNIT ")
    text = F.regexp_replace(text, POST_BOX, "$1PO BOX ")
    parts = F.filter(F.transform(F.split(text, ","), lambda p: F.trim(p)), lambda p: p != "")
    step = df.select(*keep, parts.alias("__parts"))
    step = step.select(*keep, F.when(last.isin(*COUNTRIES), rest).otherwise(c("__parts")).alias("__parts"))

    # ZIP code at the end of the last part
    without_zip = F.trim(F.regexp_replace(last, ZIP, ""))
    step = step.select(*keep, F.regexp_extract(last, ZIP, 1).alias("__zip"), without_zip.alias("__left_over"), "__parts")
    step = step.select(*keep, "__zip", (
        F.when(c("__zip") == "", c("__parts"))
        .when(c("__left_over") == "", rest)
        .otherwise(F.concat(rest, F.array("__left_over")))
    ).alias("__parts"))

    # state: a whole part, or the last word of one, but never out of the first part or out of a unit
    codes = _lookup(state_codes())
    movable = (F.size("__parts") > 1) & ~last.rlike(UNIT_START)
    step = step.select(
        *keep, "__zip", "__parts",
        F.when(movable, F.try_element_at(codes, last)).alias("__whole"),
        F.when(movable, F.regexp_extract(last, "^(.+) ([A-Z]{2})$", 2)).alias("__word"),
    )
    step = step.select(*keep, "__zip", "__parts", "__whole", F.try_element_at(codes, c("__word")).alias("__tail"))
    step = step.select(*keep, "__zip", F.coalesce("__whole", "__tail").alias("__region"), (
        F.when(c("__whole").isNotNull(), rest)
        .when(c("__tail").isNotNull(), F.concat(rest, F.array(F.regexp_replace(last, " [A-Z]{2}$", ""))))
        .otherwise(c("__parts"))
    ).alias("__parts"))

    # city: the last part left, again never the first and never a unit
    step = step.select(*keep, "__zip", "__region", "__parts", movable.alias("__movable"))
    step = step.select(
        *keep, "__zip", "__region",
        F.when(c("__movable"), last).alias("__town"),
        F.array_join(F.when(c("__movable"), rest).otherwise(c("__parts")), " ").alias("__street"),
    )
    split_unit = c("__street").rlike(UNIT_SPLIT)
    step = step.select(
        *keep, "__zip", "__region", "__town",
        F.when(split_unit, F.regexp_extract("__street", UNIT_SPLIT, 1)).otherwise(c("__street")).alias("__line1"),
        F.when(split_unit, F.concat_ws(
            " ", F.regexp_extract("__street", UNIT_SPLIT, 2), F.regexp_extract("__street", UNIT_SPLIT, 3),
        )).alias("__line2"),
    )
    valid = (c("__zip") != "") & c("__line1").rlike(STREET_START)
    return step.select(
        *keep,
        F.when(valid, _words(c("__line1"), abbreviations(STREET_WORDS))).otherwise(c(address)).alias("address_line_1"),
        F.when(valid, _words(c("__line2"), abbreviations(UNIT_WORDS))).alias("address_line_2"),
        F.when(valid, c("__town")).alias("city"),
        F.when(valid, c("__region")).alias("state"),
        F.when(valid, c("__zip")).alias("postal_code"),
    ).withColumn("mapped_address", F.concat_ws(", ", *COLUMNS[:5]))
