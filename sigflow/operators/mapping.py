"""Signal-name mapping: the mapping relation, column renames and the long join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sigflow.schemas import SIGNAL_MAPPING

def signal_mapping(
    spark: SparkSession, rows: list[tuple[str, str]] | None = None, view: str | None = "mapping_table"
) -> DataFrame:
    """Mapping relation ``(sig_name, sig_mapping_name)`` as a SQL ``UNION ALL``
    of literal rows, registered as a temp view when ``view`` is given."""
    rows = rows or SIGNAL_MAPPING

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    first = f"SELECT {q(rows[0][0])} AS sig_name, {q(rows[0][1])} AS sig_mapping_name"
    rest = [f"SELECT {q(a)}, {q(b)}" for a, b in rows[1:]]
    sql = "\nUNION ALL\n".join([first, *rest])
    if view:
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {view} AS {sql}")
        return spark.table(view)
    return spark.sql(sql)


def _ordered(mapping: DataFrame, order_col: str | None) -> DataFrame:
    """Mapping rows with their place ``ord``: the given column, else the rows' order in the plan."""
    place = F.col(order_col) if order_col else F.monotonically_increasing_id()
    return mapping.select("sig_name", "sig_mapping_name", place.alias("ord"))


# Mappings of so many rows at most are read whole; their renames are followed on the driver.
SMALL_MAPPING = 10_000


def rename_mapped(df: DataFrame, mapping: DataFrame, order_col: str | None = None) -> DataFrame:
    """Rename columns by the mapping, row by row in mapping order; a row whose
    ``sig_name`` is not (or no longer) a column is skipped. ``order_col`` fixes
    the row order; a mapping spread over files has no order of its own. Rows
    without a name, a new name or a place change nothing.

    A mapping of at most ``SMALL_MAPPING`` rows is read whole, in one job, and
    settles every rename. Beyond that the mapping stays where it is and all
    columns take their steps together, see :func:`_steps`.
    """
    rows = _ordered(mapping, order_col).dropna()
    near = rows.limit(SMALL_MAPPING + 1).collect()
    renames = _replay(near, df.columns) if len(near) <= SMALL_MAPPING else _steps(rows, df.columns)
    return df.withColumnsRenamed(renames) if renames else df


def _replay(rows: list[Row], columns: list[str]) -> dict[str, str]:
    """Renames of ``columns`` by mapping rows: each column follows, in order, the rows
    that name what it is called by then."""
    by_name: dict[str, list[tuple]] = {}
    for r in sorted(rows, key=lambda r: (r.ord, r.sig_mapping_name)):
        by_name.setdefault(r.sig_name, []).append((r.ord, r.sig_mapping_name))
    renames = {}
    for column in columns:
        name, last = column, None
        while nxt := next(((o, new) for o, new in by_name.get(name, []) if last is None or o > last), None):
            last, name = nxt
        if name != column:
            renames[column] = name
    return renames


def _steps(rows: DataFrame, columns: list[str]) -> dict[str, str]:
    """The same for a mapping of any size. A column's next rename is the first row
    after its last one that names it. All columns take their next step together:
    one aggregate over the mapping that returns at most a row per distinct current
    name and place, so the driver sees no more rows than there are columns."""
    current = {c: (c, None) for c in columns}  # column -> its name now, the place of its last rename
    live = set(columns)
    while live:
        steps = sorted({current[c] for c in live}, key=str)
        hits = []
        for k, (name, last) in enumerate(steps):
            fits = F.col("sig_name") == name
            hits.append(fits if last is None else fits & (F.col("ord") > last))
        picks = [
            F.min(F.when(h, F.struct("ord", "sig_mapping_name"))).alias(f"step{k}") for k, h in enumerate(hits)
        ]
        named = rows.filter(F.col("sig_name").isin([n for n, _ in steps]))
        found = dict(zip(steps, named.agg(*picks).first()))
        live = {c for c in live if found[current[c]] is not None}
        current.update({c: (found[current[c]].sig_mapping_name, found[current[c]].ord) for c in live})
    return {c: name for c, (name, _) in current.items() if c != name}


def mapping_join_long(
    df: DataFrame, mapping: DataFrame, id_cols: list[str], value_cols: list[str] | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """Long form ``(*id_cols, sig_name, sig_mapping_name, value)``: one row per
    id and numeric signal column, named through the mapping (unmapped names
    keep their own name).

    The mapping side is cut to rows naming one of ``value_cols`` and, by a
    grouped aggregate, to one row per name (the first in mapping order), so
    its size is bounded by the column count and broadcasting it is safe
    whatever the mapping's size.
    """
    if value_cols is None:
        value_cols = [
            f.name for f in df.schema.fields
            if f.name not in id_cols and isinstance(f.dataType, NumericType)
        ]
    long = df.unpivot(id_cols, value_cols, "sig_name", "value")
    named = _ordered(mapping, order_col).filter(F.col("sig_name").isin(value_cols))
    side = named.groupBy("sig_name").agg(F.min_by("sig_mapping_name", "ord").alias("sig_mapping_name"))
    joined = long.join(F.broadcast(side), "sig_name", "left")
    return joined.select(
        *id_cols,
        "sig_name",
        F.coalesce("sig_mapping_name", "sig_name").alias("sig_mapping_name"),
        "value",
    )
