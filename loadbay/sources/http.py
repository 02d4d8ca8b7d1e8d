"""HTTP bodies as rows.

URLs are a DataFrame; executors fetch them (``mapInPandas``, one fetch per
URL, spread by ``repartition``); bodies are cut into lines and fields with
Column expressions.  ``url_fetch`` makes the default fetch; any other function
from a URL to its body may take its place.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay.functions import text as tx


def url_list(spark: SparkSession, urls: str) -> DataFrame:
    """``"u1;u2;..."`` -> one row per URL (the list is the job's parameter)."""
    items = [u.strip() for u in urls.split(";") if u.strip()]
    return spark.createDataFrame([(u,) for u in items], "url string")


def url_fetch(charset: str | None = None, timeout: float = 60.0) -> Callable[[str], str]:
    """A fetch through ``urllib``: the body in ``charset``, else in the one that
    the response names, else UTF-8.  A failed request, a status that is no
    success and a timeout raise, so the task is retried and the job fails in
    the end; no URL is passed over."""
    def fetch(url: str) -> str:
        with urlopen(url, timeout=timeout) as response:
            return response.read().decode(charset or response.headers.get_content_charset() or "utf-8", "replace")

    return fetch


def fetch_bodies(urls: DataFrame, fetch: Callable[[str], str],
                 num_partitions: int | None = None) -> DataFrame:
    """``(url, body)``: each executor fetches its share of the URLs."""
    spread = urls.repartition(num_partitions) if num_partitions else urls

    def run(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"url": pdf["url"], "body": [fetch(u) for u in pdf["url"]]})

    return spread.select("url").mapInPandas(run, "url string, body string")


def parse_bodies(df: DataFrame, field_split: str = ",", null_string: str | None = "",
                 url_col: str = "url", body_col: str = "body",
                 num_fields: int | None = None) -> DataFrame:
    """R15 body rules: lines as a line reader gives them, each line split by
    the *regex* ``field_split`` with trailing empty fields dropped, fields
    equal to ``null_string`` -> NULL.  Output: ``url, line_no, fields`` or
    ``url, line_no, _c0..``."""
    lines = df.select(F.col(url_col).alias("url"),
                      F.posexplode(tx.split_lines(F.col(body_col))).alias("line_no", "line"))
    fields = tx.null_map_fields(tx.split_line_regex(F.col("line"), field_split), null_string)
    if num_fields is None:
        return lines.select("url", "line_no", fields.alias("fields"))
    return lines.select("url", "line_no", *tx.fields_to_columns(fields, num_fields))


def read_http(spark: SparkSession, urls: str | DataFrame, fetch: Callable[[str], str] | None = None,
              field_split: str = ",", null_string: str | None = "",
              num_fields: int | None = None, charset: str | None = None,
              timeout: float = 60.0) -> DataFrame:
    """Fetch every URL (``url_fetch`` unless ``fetch`` is given) and turn
    its body into rows."""
    url_df = url_list(spark, urls) if isinstance(urls, str) else urls
    return parse_bodies(fetch_bodies(url_df, fetch or url_fetch(charset, timeout)), field_split, null_string,
                        num_fields=num_fields)
