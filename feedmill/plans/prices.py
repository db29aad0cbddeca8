"""The five market-price feeds in the shape of the price table.

The views that do this for the source system are not published with its load
jobs. Their column lists are; how a source, code, frequency or location comes
about is our choice and is stated at each view. Every view gives all price
columns with their core types, one row per price quote, and never a NULL
frequency: a NULL in the match key would insert the quote again on each rerun.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.text import blank_to_null, typed_null
from feedmill.functions.typing import compact_clock, compact_day, to_day, to_number
from feedmill.operators.lookup import decode
from feedmill.operators.reshape import unpivot
from feedmill.operators.summary import pivot_kinds
from feedmill.tables import table

MIDNIGHT = "00:00:00"
DAILY = "D"

# Fixed values of our choice: what the crack file's three price series stand for.
CRACK_SERIES = {"WTI": "BBL", "Gasoline": "GAL", "Diesel": "GAL"}

# Exchange month letters, January to December.
MONTH_LETTERS = "FGHJKMNQUVXZ"

# Fixed values of our choice: unit per futures root and currency per country.
FUTURES_UNITS = {"CL": "BBL", "HO": "GAL", "RB": "GAL", "NG": "MMB"}
CURRENCIES = {"US": "USD", "CA": "CAD", "MX": "MXN"}

# Fixed values of our choice: last letter of a price code to the column it fills.
PRICE_KINDS = {
    "L": "Price_Low",
    "H": "Price_High",
    "C": "Price_Avg",
    "U": "Price_Index",
    "W": "Price_Volume",
}


def _choose(c: Column, values: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in values.items()])


def _complete(df: DataFrame) -> DataFrame:
    """All price columns in order, absent ones as typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(c).cast(t) if c in have else typed_null(t)).alias(c)
            for c, t in table("price").columns.items()
        ]
    )


def crack_view(stage: DataFrame) -> DataFrame:
    """Three (date, price) pairs per row, each series with its own date.

    Only the closing price is filled. A pair without a date has no quote.
    """
    branches = [
        {
            "Price_Type": F.lit("SPOT"),
            "Price_Date": to_day(F.col(f"{series}_Date")),
            "Price_Code": F.lit(series.upper()),
            "Price_Description": F.lit(f"{series} daily price"),
            "Price_Close": to_number(F.col(f"{series}_Price")),
            "Price_UOM": F.lit(unit),
        }
        for series, unit in CRACK_SERIES.items()
    ]
    quotes = unpivot(stage, [], branches, keep=F.col("Price_Date").isNotNull())
    return _complete(
        quotes.withColumns(
            {
                "Price_Source": F.lit("CRACK"),
                "Price_Time": F.lit(MIDNIGHT),
                "Price_Freq": F.lit(DAILY),
                "Price_Country": F.lit("US"),
                "Price_Currency": F.lit("USD"),
            }
        )
    )


def contract_month(month: Column, year: Column) -> Column:
    """First day of a contract month from its letter and two-digit year.

    Years below 70 are in this century.
    """
    number = F.instr(F.lit(MONTH_LETTERS), F.upper(month))
    short = F.trim(year).try_cast("int")
    full = F.when(short < 70, short + 2000).otherwise(short + 1900)
    return F.when((F.length(month) == 1) & (number > 0), F.make_date(full, number, F.lit(1)))


def futures_view(stage: DataFrame) -> DataFrame:
    """Futures quotes; the code is root, month letter and year. Open interest is dropped."""
    root, letter, year = (F.trim(c) for c in ("Price_Type", "Price_FutureMonth", "Price_FutureYear"))
    month = F.date_format(contract_month(letter, year), "MMM yyyy")
    return _complete(
        stage.select(
            F.lit("FUTURES").alias("Price_Source"),
            "Price_Type",
            to_day(F.col("Price_Date")).alias("Price_Date"),
            F.lit(MIDNIGHT).alias("Price_Time"),
            F.upper(F.concat(root, letter, year)).alias("Price_Code"),
            F.lit(DAILY).alias("Price_Freq"),
            F.concat_ws(" ", F.upper(root), F.lit("futures"), month).alias("Price_Description"),
            *[
                to_number(F.col(c)).alias(c)
                for c in ("Price_Open", "Price_Low", "Price_High", "Price_Close", "Price_Volume")
            ],
            _choose(F.upper(root), FUTURES_UNITS).alias("Price_UOM"),
        )
    )


def opis_view(stage: DataFrame, price_type: str) -> DataFrame:
    """Rack and spot assessments, known by their description only.

    The code is the description in capitals with runs of other characters as
    underscores, the location its first word, the currency that of the country.
    """
    text = F.trim("Price_Description")
    return _complete(
        stage.select(
            F.lit("OPIS").alias("Price_Source"),
            F.lit(price_type).alias("Price_Type"),
            to_day(F.col("Price_Date")).alias("Price_Date"),
            F.lit(MIDNIGHT).alias("Price_Time"),
            F.regexp_replace(F.upper(text), "[^A-Z0-9]+", "_").alias("Price_Code"),
            F.coalesce("Price_Freq", F.lit(DAILY)).alias("Price_Freq"),
            F.regexp_extract(text, r"^([A-Za-z0-9]+)", 1).alias("Price_Location"),
            "Price_Description",
            *[to_number(F.col(c)).alias(c) for c in ("Price_Low", "Price_High", "Price_Avg")],
            "Price_UOM",
            "Price_Country",
            "Price_DeliveryType",
            _choose(F.upper("Price_Country"), CURRENCIES).alias("Price_Currency"),
        )
    )


def opis_feedstock_view(stage: DataFrame) -> DataFrame:
    return opis_view(stage, "FEEDSTOCK")


def opis_spot_view(stage: DataFrame) -> DataFrame:
    return opis_view(stage, "SPOT")


def one_entry_per_code(dictionary: DataFrame) -> DataFrame:
    """The price dictionary with the first category's entry where a code has several."""
    taken = ("Price_Code", "Price_Freq", "Price_Currency", "Price_UOM", "Price_Description",
             "Price_Location")
    return (
        dictionary.groupBy(F.upper(F.rtrim("Price_Code")).alias("_code"))
        .agg(F.min_by(F.struct(*taken), F.struct("Price_MDC", "Price_Code")).alias("e"))
        .select("e.*")
    )


def known_kind(code: Column) -> Column:
    """Whether the last letter of a price code says which price it is."""
    return F.right(F.upper(F.rtrim(code)), F.lit(1)).isin(*PRICE_KINDS)


def platts_view(stage: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One price per (code, time) to one row per (symbol, time).

    A code is a symbol and a last letter that says which price it is. The symbol
    is looked up in the price dictionary; symbols it lacks are kept undecoded.
    Codes of an unknown kind make no row: the load reports them as refused.
    """
    code = F.upper(F.rtrim("Price_Code"))
    quotes = stage.filter(known_kind(F.col("Price_Code"))).select(
        F.expr("substring(upper(rtrim(Price_Code)), 1, length(rtrim(Price_Code)) - 1)").alias(
            "Price_Code"
        ),
        F.right(code, F.lit(1)).alias("_kind"),
        compact_day(F.col("Price_DateTime")).alias("Price_Date"),
        compact_clock(F.col("Price_DateTime")).alias("Price_Time"),
        to_number(F.col("Price")).alias("_price"),
    )
    rows = pivot_kinds(
        quotes,
        ("Price_Code", "Price_Date", "Price_Time"),
        F.col("_kind"),
        F.col("_price"),
        PRICE_KINDS,
    )
    entries = one_entry_per_code(dictionary)
    rows = decode(
        rows,
        entries,
        [("Price_Code", "Price_Code")],
        ("Price_Freq", "Price_Currency", "Price_UOM", "Price_Description", "Price_Location"),
        how="left",
    )
    return _complete(
        rows.withColumns(
            {
                "Price_Source": F.lit("PLATTS"),
                "Price_Type": F.lit("ASSESSMENT"),
                "Price_Freq": F.coalesce(blank_to_null(F.col("Price_Freq")), F.lit(DAILY)),
            }
        )
    )


def all_quotes(*views: DataFrame) -> DataFrame:
    """Several feeds as one stage: one upsert rewrites the price table once."""
    return reduce(DataFrame.unionByName, views)
