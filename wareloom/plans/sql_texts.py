"""SQL fragments shared by the checking statements."""

from __future__ import annotations

from wareloom.plans.driver_tables import LISTING_SQL
from wareloom.schema import FIRST_COLUMNS, MODAL_COLUMNS

FLAGS = ["local_pickup", "free_shipping", "accepts_mercadopago", "automatic_relist"]


def with_listing(body: str, *parts: str) -> str:
    return "WITH " + ",\n".join([LISTING_SQL, *parts]) + "\n" + body


def entity_part(key: str, name: str = "entity", source: str = "listing", nulls: str = "count") -> str:
    """CTEs ending in ``name``: one row per key with all columns."""
    names = ", ".join(f"'{out}'" for out in MODAL_COLUMNS.values())
    cells = ", ".join(f"{c}::varchar" for c in MODAL_COLUMNS)
    picks = ",\n    ".join(
        f"max(v) FILTER (cell = '{out}'){'::boolean' if out in FLAGS else ''} AS {out}"
        for out in MODAL_COLUMNS.values()
    )
    order = ", ".join(f"{c} NULLS FIRST" for c in [*FIRST_COLUMNS, "price"])
    firsts = ", ".join(f"first({c} ORDER BY {order}) AS {c}" for c in FIRST_COLUMNS)
    keep = "" if nulls == "count" else "WHERE value IS NOT NULL"
    p = name
    return f"""{p}_cells AS (
  SELECT {key} AS k, unnest([{names}]) AS cell, unnest([{cells}]) AS value FROM {source}),
{p}_tally AS (SELECT k, cell, value, count(*) AS n FROM {p}_cells {keep} GROUP BY k, cell, value),
{p}_best AS (
  SELECT k, cell, first(value ORDER BY n DESC, value IS NULL, value) AS v FROM {p}_tally GROUP BY k, cell),
{p}_modes AS (
  SELECT k, {picks}
  FROM {p}_best GROUP BY k),
{p}_numbers AS (
  SELECT {key} AS k, first(price ORDER BY {order}) AS unit_price,
    coalesce(sum(sold_quantity), 0)::bigint AS total_quantity,
    coalesce(sum(initial_quantity), 0)::bigint AS stock_quantity,
    coalesce(sum(available_quantity), 0)::bigint AS available_quantity, {firsts}
  FROM {source} GROUP BY {key}),
{name} AS (
  SELECT n.k AS {key}, m.* EXCLUDE (k), n.* EXCLUDE (k), unit_price * total_quantity AS total_amount,
    date_sub('second', date_created, last_updated) / 3600.0 AS date_difference_hr,
    date_sub('second', start_time, stop_time) / 3600.0 AS time_difference_hr
  FROM {p}_numbers n LEFT JOIN {p}_modes m ON n.k IS NOT DISTINCT FROM m.k)"""


HELPERS = "unit_price, total_quantity, date_created, last_updated, start_time, stop_time"


def stored_columns(key: str) -> str:
    """Columns of the stored entity table, doubles rounded."""
    modal = ", ".join(MODAL_COLUMNS.values())
    return (
        f"{key}, {modal}, stock_quantity, available_quantity, round(total_amount, 4) AS total_amount, "
        "round(date_difference_hr, 4) AS date_difference_hr, round(time_difference_hr, 4) AS time_difference_hr"
    )
