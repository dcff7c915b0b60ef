"""Access-control strings of warehouse tables as one row per grant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Privilege letters.
GRANTS = {
    "r": "SELECT",
    "w": "UPDATE",
    "a": "INSERT",
    "d": "DELETE",
    "D": "DROP",
    "x": "REFERENCES",
    "t": "TRIGGER",
    "R": "RULE",
}


# A comma that is followed by an even number of quotation marks separates entries.
_SEPARATOR = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
_SHAPE = r"^[^=]*=[^/=]*/[^/=]+$"


def _entry(raw: Column) -> Column:
    """``user=letters/owner`` as a struct. ``*`` (may be passed on) and unknown letters are left out."""
    entry = F.btrim(raw, F.lit('"'))
    user = F.substring_index(entry, "=", 1)
    rights = F.substring_index(entry, "=", -1)
    letters = F.split(F.substring_index(rights, "/", 1), "")
    names = F.create_map(*[F.lit(x) for pair in GRANTS.items() for x in pair])
    grants = F.filter(F.transform(letters, lambda c: F.try_element_at(names, c)), lambda g: g.isNotNull())
    return F.struct(
        F.when(user == "", F.lit("PUBLIC")).otherwise(F.regexp_replace(user, "^group ", "")).alias("name"),
        ((user == "") | user.startswith("group ")).alias("is_group"),
        grants.alias("grants"),
        F.substring_index(rights, "/", -1).alias("owner"),
    )


def parse_acl(raw: Column) -> Column:
    """The entries of ``{user=arwd/owner,"group g,h=r/owner"}``. Commas in quotation marks belong to names.

    An empty or missing text has no entries, and neither have empty braces. NULL comes back for a text that is not in
    braces or has an entry of another form.
    """
    none = F.array().cast("array<struct<name:string,is_group:boolean,grants:array<string>,owner:string>>")
    text = F.coalesce(raw, F.lit(""))
    parts = F.split(F.regexp_replace(text, r"^\{|\}$", ""), _SEPARATOR)
    shaped = F.forall(parts, lambda p: F.btrim(p, F.lit('"')).rlike(_SHAPE))
    in_braces = text.startswith("{") & text.endswith("}")
    return F.when(text.isin("", "{}"), none).when(in_braces & shaped, F.transform(parts, _entry))


def explode_acl(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per grant. Texts without entries, or malformed ones, have no rows."""
    entries = df.select(*keep, F.explode(parse_acl(F.col(column))).alias("e"))
    return entries.select(*keep, "e.name", "e.is_group", "e.owner", F.explode("e.grants").alias("grant"))
