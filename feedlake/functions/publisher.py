"""Publisher label from an article URL."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import constants as C
from feedlake.functions.text import let, literal_map, nonempty, or_empty


def host_of(url) -> Column:
    """Lower-cased host without port; '' when the URL has none."""
    netloc = F.regexp_extract(or_empty(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.substring_index(F.lower(netloc), ":", 1)


def publisher(
    url,
    *,
    table: dict[str, str] = C.PUBLISHERS,
    prefixes=C.HOST_PREFIXES,
    portal_mark: str = C.PORTAL_HOST_MARK,
    portal_label: str = C.PORTAL_LABEL,
) -> Column:
    """Label of the exact host, else of the host without one leading prefix, else that host.

    The table is a configuration constant, folded into the plan as a map literal, so the
    lookup is a projection and not a join.
    """
    labels = literal_map(table)
    prefix = rf"^(?:{'|'.join(prefixes)})\."

    def label(host: Column) -> Column:
        short = F.regexp_replace(host, prefix, "")
        return F.when((host == "") | host.contains(portal_mark), portal_label).otherwise(
            F.coalesce(
                F.try_element_at(labels, host),
                F.try_element_at(labels, short),
                nonempty(short),
                F.lit(portal_label),
            )
        )

    return let(host_of(url), label)
