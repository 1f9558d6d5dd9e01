"""Relational sinks through Spark's JDBC writer.

Connection options (URL, user, password, driver) always come from the
caller; nothing is built in.  Row preparation lives in
``usagetally.operators.relational`` and is tested without a database.  Callers
hand over staged tables: the writers' few connections then hold up a plain scan,
not the job that made the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_HEX = "0123456789abcdef"


def read_table(spark: SparkSession, table: str, options: dict[str, str], key: str = "id",
               prefix_chars: int = 2) -> DataFrame:
    """Read a relational table keyed by an MD5 hex text in parallel.

    A JDBC read without partitioning options is a single task; the key is
    uniform hex, so ``16**prefix_chars`` key ranges split the read into that
    many equal parts (rows whose key is not lowercase hex fall in one extra
    part, so none are lost)."""
    url = options["url"]
    props = {k: v for k, v in options.items() if k != "url"}
    return spark.read.jdbc(url, table, predicates=key_prefix_predicates(key, prefix_chars),
                           properties=props)


def key_prefix_predicates(key: str, prefix_chars: int = 2) -> list[str]:
    """Disjoint WHERE clauses covering every row: a key range for each hex
    prefix of ``key`` (a range, so that an index on the key serves each read),
    plus one for keys that are NULL or don't begin like lowercase hex."""
    prefixes = [""]
    for _ in range(prefix_chars):
        prefixes = [p + h for p in prefixes for h in _HEX]
    # after the last digit of a run of prefixes comes the character that sorts next: ':' after 9, 'g' after f
    ends = [p[:-1] + chr(ord(p[-1]) + 1) for p in prefixes]
    ranges = [f"({key} >= '{low}' and {key} < '{high}')" for low, high in zip(prefixes, ends, strict=True)]
    return ranges + [f"({key} is null or not ({' or '.join(ranges)}))"]


def update_statement(target: str, changes: str, columns: list[str], key: str = "id", dialect: str = "merge") -> str:
    """One set-based statement that applies the staged ``changes`` to ``target``.

    The staging table holds the new values, not increments (``relational_changed_rows``), so running the
    statement again changes nothing.  ``dialect``: ``merge`` (SQL:2003) or ``join`` (UPDATE … JOIN)."""
    if dialect == "join":
        sets = ", ".join(f"t.{c} = s.{c}" for c in columns)
        return f"UPDATE {target} t JOIN {changes} s ON t.{key} = s.{key} SET {sets}"
    if dialect != "merge":
        raise ValueError("dialect must be 'merge' or 'join'")
    sets = ", ".join(f"{c} = s.{c}" for c in columns)
    return f"MERGE INTO {target} AS t USING {changes} AS s ON t.{key} = s.{key} WHEN MATCHED THEN UPDATE SET {sets}"


def _writer(df: DataFrame, table: str, options: dict[str, str], mode: str, **extra):
    w = df.write.format("jdbc").option("dbtable", table).mode(mode)
    for k, v in {**options, **extra}.items():
        w = w.option(k, v)
    return w


def replace_summary(summary: DataFrame, table: str, options: dict[str, str],
                    batchsize: int = 10000, writers: int = 20) -> None:
    """K8: truncate the summary table and insert the new counts in batches.

    ``writers`` bounds concurrent connections (``numPartitions``)."""
    _writer(summary, table, options, "overwrite", truncate="true",
            batchsize=str(batchsize), numPartitions=str(writers)).save()


def append_rows(rows: DataFrame, table: str, options: dict[str, str],
                batchsize: int = 10000, writers: int = 20) -> None:
    """Append prepared insert rows (already anti-joined on the id)."""
    _writer(rows, table, options, "append", batchsize=str(batchsize),
            numPartitions=str(writers)).save()


def stage_changes(changes: DataFrame, table: str, options: dict[str, str],
                  batchsize: int = 10000, writers: int = 20) -> None:
    """K10 (default): write the changed rows' new values to ``table`` (a
    staging table, replaced each run) for the database to apply in one
    set-based statement (``update_statement``); the target table is never emptied."""
    replace_summary(changes, table, options, batchsize, writers)


def replace_with_updated(updated: DataFrame, table: str, options: dict[str, str],
                         batchsize: int = 10000, writers: int = 20) -> None:
    """Publish the post-update table computed by J9 (truncate + insert).

    The update is computed as a DataFrame first, so the write is idempotent."""
    replace_summary(updated, table, options, batchsize, writers)
