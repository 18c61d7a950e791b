"""Functions by name for queries written as SQL text.

``register`` gives a session the table function ``page_elements(html)``, to be used with
LATERAL, and some URL functions, which are SQL expressions themselves and so stay open to
the optimizer.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pageloom.functions.dom import _Batch
from pageloom.functions.url import MAX_URL_BYTES

ELEMENT_COLUMNS = "id int, parent int, place int, end int, tag string, attrs map<string,string>, own_text string"


class PageElements:
    """The elements of a page in page order, numbered as in the element tree.

    ``place`` counts the children of a parent from 0, ``end`` is the number behind the last
    descendant, ``own_text`` the text directly inside.  NULL and empty pages have none.
    """

    def eval(self, html: str) -> Iterator[tuple]:
        if not html:
            return
        batch = _Batch()
        batch.add_page(html)
        texts: dict[int, list[str]] = {}
        for piece, owner in zip(batch.text, batch.owner):
            texts.setdefault(owner, []).append(piece)
        for number, (parent, place, end, tag) in enumerate(batch.elements()):
            low, high = batch.attr_at[number], batch.attr_at[number + 1]
            attrs = dict(zip(batch.keys[low:high], batch.values[low:high]))
            yield number, parent, place, end, tag, attrs, "".join(texts.get(number, ())).strip()


#: Name, arguments, and the expression it stands for.
SQL_FUNCTIONS = {
    "url_host": ("url STRING", r"lower(substring_index(regexp_extract(url, '^.*?://([^/?#]*)', 1), ':', 1))"),
    "url_page": ("url STRING", r"concat('/', regexp_extract(url, '^.*?://[^/?#]*/([^?#]*)', 1))"),
    "url_is_usable": ("url STRING", rf"url rlike '^(?i:https?)://[^/?#]' and octet_length(url) <= {MAX_URL_BYTES}"),
    "base_host": ("host STRING", r"regexp_replace(lower(host), '^www[.](?=.)', '')"),
}


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session; again is harmless."""
    spark.udtf.register("page_elements", F.udtf(PageElements, returnType=ELEMENT_COLUMNS))
    for name, (arguments, expression) in SQL_FUNCTIONS.items():
        kind = "BOOLEAN" if name.startswith("url_is") else "STRING"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {expression}")
