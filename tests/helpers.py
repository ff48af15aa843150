import datetime as dt

from changeloom import KeyedTable, SystemColumns, TableSpec

SYS = SystemColumns()
END = "9999-12-31T23:59:59.999Z"


def ts(text):
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00"))


def utc(value):
    """Comparable text of a timestamp; collected ones are naive, in the zone that conftest sets."""
    return value.replace(tzinfo=None).isoformat() if isinstance(value, dt.datetime) else value


def table(spark, data, ddl, keys, **kwargs):
    df = spark.createDataFrame(data, ddl)
    return KeyedTable(df, TableSpec.of(df, keys, **kwargs))


def rows(table_or_df, *columns):
    df = getattr(table_or_df, "df", table_or_df)
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
