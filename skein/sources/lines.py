"""Lenient text line -> typed record parsing as a Spark job, with rejects kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.text import split_fields

# Field kinds: "req" must be present and parse; "opt" must be present, the null token
# means absent; "tail" may also be missing from the end of the line.
# Positions, names and kinds of the three record layouts.
LAYOUTS = {
    "airport": [
        (1, "id", "bigint", "req", False), (2, "name", "string", "req", True),
        (3, "city", "string", "req", True), (4, "country", "string", "req", True),
        (5, "iata", "string", "opt", True), (6, "icao", "string", "opt", True),
        (7, "latitude", "double", "req", False), (8, "longitude", "double", "req", False),
        (9, "altitude", "double", "req", False),
    ],
    "airport_extended": [
        (1, "id", "bigint", "req", False), (2, "name", "string", "req", True),
        (3, "city", "string", "req", True), (4, "country", "string", "req", True),
        (7, "latitude", "double", "req", False), (8, "longitude", "double", "req", False),
        (9, "altitude", "double", "req", False), (10, "timezone", "int", "opt", False),
        (11, "dst", "string", "opt", False),
    ],
    "route": [
        (1, "airline", "string", "req", False), (2, "airline_id", "bigint", "opt", False),
        (3, "source_airport", "string", "req", False), (4, "source_airport_id", "bigint", "req", False),
        (5, "dest_airport", "string", "req", False), (6, "dest_airport_id", "bigint", "req", False),
        (7, "codeshare", "string", "opt", False), (8, "stops", "int", "req", False),
        (9, "equipment", "string", "tail", False),
    ],
}

NULL_TOKEN = "\\N"
_MISSING = "\u0002"


def _typed(raw: Column, dtype: str) -> Column:
    if dtype == "string":
        return raw
    if dtype in ("bigint", "int"):
        # integral text only: "1.5" must not truncate to 1
        return F.when(raw.rlike(r"^[+-]?[0-9]+$"), raw.try_cast(dtype))
    return raw.try_cast(dtype)


def parse_lines(lines: DataFrame, layout: str, value_col: str = "value", quoted: bool = True,
                on_bad: str = "reject", null_token: str = NULL_TOKEN) -> tuple[DataFrame, DataFrame]:
    """Parse one record per line into the layout's typed columns.

    Returns ``(good, rejects)``; ``rejects`` holds ``(line, reason)`` for every line that
    does not fit. ``quoted=True`` follows CSV quoting rules (a quoted comma stays in its
    field); ``quoted=False`` splits on every separator, strips double quotes from the
    name fields and ignores trailing empty fields, as the reference's record parsers do.
    Empty optional text becomes null. ``on_bad="fail"`` raises on the first bad line.
    """
    fields = LAYOUTS[layout]
    width = max(pos for pos, *_ in fields)
    line = F.col(value_col)
    if quoted:
        # Fields missing from the end of a line are told apart from empty ones by
        # appending ``width`` sentinel fields before parsing with CSV quoting rules.
        padded = F.concat(line, F.lit((",%s" % _MISSING) * width))
        ddl = ", ".join(f"f{i} string" for i in range(1, width + 1))
        base = lines.select(line.alias("line"), F.from_csv(padded, ddl, {"mode": "PERMISSIVE"}).alias("__rec"))
        # a missing field becomes null, an empty one ""
        raw_of = {pos: F.nullif(F.coalesce(F.col("__rec")[f"f{pos}"], F.lit("")), F.lit(_MISSING))
                  for pos, *_ in fields}
    else:
        parts = split_fields(F.regexp_replace(line, ",+$", ""))
        base = lines.select(line.alias("line"), parts.alias("__parts"))
        raw_of = {pos: F.try_element_at(F.col("__parts"), F.lit(pos)) for pos, *_ in fields}
        raw_of = {pos: (F.regexp_replace(raw_of[pos], '"', "") if strip else raw_of[pos])
                  for pos, _, _, _, strip in fields}
    # A row generator of one row ends each stage: filters on a field are not pushed below it, where the
    # optimizer would write out the whole splitting of the line again for every use of the field.
    raws = base.select("line", F.inline(F.array(F.struct(*[raw_of[pos].alias(f"__raw{pos}") for pos, *_ in fields]))))

    # typed value: null when missing, the null token, empty optional text or unparsable
    vals = []
    for pos, name, dtype, kind, _ in fields:
        raw = F.col(f"__raw{pos}")
        blank = raw == F.lit(null_token) if kind == "req" else raw.isin(null_token, "")
        vals.append(F.when(~blank, _typed(raw, dtype)).cast(dtype).alias(f"__val{pos}"))
    valued = raws.select("line", *[f"__raw{pos}" for pos, *_ in fields], F.inline(F.array(F.struct(*vals))))

    # a field is bad when required and without value, when missing although optional, or
    # when text that is neither blank nor the null token does not parse
    flags = []
    for pos, name, dtype, kind, _ in fields:
        raw, value = F.col(f"__raw{pos}"), F.col(f"__val{pos}")
        if kind == "req":
            bad = value.isNull()
        else:
            bad = F.coalesce(~raw.isin(null_token, "") & value.isNull(), F.lit(False))
            if kind == "opt":
                bad = bad | raw.isNull()
        flags.append(F.when(bad, F.lit(name)).alias(f"__bad{pos}"))
    typed = valued.select("line", *[F.col(f"__val{pos}").alias(name) for pos, name, *_ in fields],
                          *flags)
    flagged = typed.withColumn("__is_bad", F.concat_ws("", *[F.col(f"__bad{pos}") for pos, *_ in fields]) != "")
    if on_bad == "fail":
        flagged = flagged.where(F.when(F.col("__is_bad"), F.raise_error(
            F.concat(F.lit("cannot parse line: "), F.col("line"))).cast("boolean")).otherwise(F.lit(True)))
    good = flagged.where(~F.col("__is_bad")).select(*[name for _, name, *_ in fields])
    rejects = flagged.where(F.col("__is_bad")).select(
        "line", F.concat(F.lit("bad field: "),
                         F.concat_ws(",", *[F.col(f"__bad{pos}") for pos, *_ in fields])).alias("reason"))
    return good, rejects
