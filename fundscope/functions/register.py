"""The scalar functions as SQL functions, and a table function, for use from Spark SQL."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

_SQL = {
    "fs_host": ("url STRING", "STRING", r"regexp_replace(regexp_extract(lower(trim(coalesce(url, ''))), '^(?:[a-z][a-z0-9+.\\-]*://)?([^/?#]*)', 1), '^www\\.', '')"),
    "fs_fiscal_year": ("d DATE", "INT", "year(d) - CAST(month(d) < 4 AS INT)"),
    "fs_is_blank": ("s STRING", "BOOLEAN", "s IS NULL OR s = ''"),
    "fs_plain_yen": ("s STRING", "BIGINT", r"try_cast(replace(regexp_extract(translate(s, '０１２３４５６７８９，', '0123456789,'), '([0-9][0-9,]*)\\s*円', 1), ',', '') AS BIGINT)"),
    "fs_upper_median": ("v ARRAY<DOUBLE>", "DOUBLE", "element_at(sort_array(v), CAST(floor(size(v) / 2) AS INT) + 1)"),
    "fs_hhi": ("v ARRAY<DOUBLE>", "DOUBLE", "coalesce(10000 * aggregate(v, 0D, (s, x) -> s + x * x) / nullif(pow(aggregate(v, 0D, (s, x) -> s + x), 2), 0), 0)"),
}


class Links:
    """(place, url, text) of the links of an HTML page."""

    def eval(self, html: str):
        for k, m in enumerate(re.finditer(r"(?is)<a\s[^>]*href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>", html or "")):
            yield k, m.group(1), re.sub(r"<[^>]*>", "", m.group(2)).strip()


def register_functions(spark: SparkSession) -> list[str]:
    """Temporary functions of this session: scalar ones as SQL expressions, which stay in generated code."""
    for name, (args, kind, body) in _SQL.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
    spark.udtf.register("fs_links", udtf(Links, returnType="place int, url string, text string"))
    return [*_SQL, "fs_links"]
