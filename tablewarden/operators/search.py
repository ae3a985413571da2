"""Search over the entity table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.model import DELETED

# Columns of the entity table; any other attribute is looked up in the attribute map.
_PLAIN = ("guid", "qualified_name", "name", "owner", "description", "status")


def search(
    entities: DataFrame,
    classifications: DataFrame | None = None,
    *,
    type_name: str | None = None,
    attributes: dict[str, str] | None = None,
    name_contains: str | None = None,
    text: str | None = None,
    tag: str | None = None,
    include_deleted: bool = False,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """Entities that meet all given criteria.

    Equality criteria come first so that they reach the scan. An entity without a status is
    live. Text is compared with
    regard to case. With a limit the page is taken in (qualified_name, guid) order; each
    task then keeps only ``offset + limit`` rows.
    """
    found = entities
    if type_name is not None:
        found = found.filter(F.col("type_name") == type_name)
    if not include_deleted:
        found = found.filter(~F.col("status").eqNullSafe(DELETED))
    for key, value in (attributes or {}).items():
        target = F.col(key) if key in _PLAIN else F.col("attributes")[key]
        found = found.filter(target == value)
    if name_contains is not None:
        found = found.filter(F.col("name").contains(name_contains))
    if text is not None:
        places = [F.col(c).contains(text) for c in ("name", "qualified_name", "description")]
        found = found.filter(F.coalesce(places[0], F.lit(False)) | places[1] | places[2])
    if tag is not None:
        tagged = classifications.filter(F.col("classification") == tag).select("guid").distinct()
        found = found.join(tagged, "guid", "left_semi").select(*entities.columns)
    if limit is not None:
        found = found.orderBy("qualified_name", "guid").offset(offset).limit(limit)
    return found
