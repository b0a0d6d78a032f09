"""Reading tables of a source database over JDBC, in parallel key ranges.

The driver jar of the database has to be on the session's class path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# Database kinds with URL form, driver class and default port.
KINDS = {
    "mysql": ("jdbc:mysql://{host}:{port}/{name}", "com.mysql.cj.jdbc.Driver", 3306),
    "postgresql": (
        "jdbc:postgresql://{host}:{port}/{name}",
        "org.postgresql.Driver",
        5432,
    ),
    "sqlite": ("jdbc:sqlite:{name}", "org.sqlite.JDBC", None),
    "oracle": (
        "jdbc:oracle:thin:@//{host}:{port}/{name}",
        "oracle.jdbc.OracleDriver",
        1521,
    ),
    "sqlserver": (
        "jdbc:sqlserver://{host}:{port};databaseName={name}",
        "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        1433,
    ),
}
# Configuration fields that may hold the database's name.
NAME_FIELDS = ("dbname", "service_name", "database")

FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Database:
    kind: str
    name: str
    host: str = "localhost"
    port: int | None = None
    user: str | None = None
    password: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown database type {self.kind!r}")

    @classmethod
    def from_config(cls, entry: Mapping[str, object]) -> Database:
        """Build from one ``database.<alias>`` entry of a configuration mapping."""
        name = next((entry[f] for f in NAME_FIELDS if f in entry), None)
        if name is None:
            raise ValueError(f"configuration needs one of {NAME_FIELDS}")
        port = entry.get("port")
        return cls(
            kind=str(entry["type"]),
            name=str(name),
            host=str(entry.get("host", "localhost")),
            port=None if port is None else int(str(port)),
            user=entry.get("user"),
            password=entry.get("password"),
        )

    @property
    def url(self) -> str:
        form, _, default_port = KINDS[self.kind]
        return form.format(
            host=self.host, port=self.port or default_port, name=self.name
        )

    def options(self) -> dict[str, str]:
        given = {
            "url": self.url,
            "driver": KINDS[self.kind][1],
            "user": self.user,
            "password": self.password,
        }
        return {k: v for k, v in given.items() if v is not None}


def databases(config: Mapping[str, Mapping]) -> dict[str, Database]:
    """All entries of a ``{"database": {alias: {...}}}`` configuration."""
    return {
        alias: Database.from_config(entry)
        for alias, entry in config["database"].items()
    }


def read_jdbc(
    spark: SparkSession,
    db: Database,
    table: str,
    split_on: str | None = None,
    splits: int = 32,
    *,
    predicates: Sequence[str] = (),
    unsplit: bool = False,
) -> DataFrame:
    """One table, read by several tasks.

    ``split_on`` names a number, date or timestamp column, read as ``splits`` ranges
    between its minimum and maximum, asked of the database. ``predicates`` gives one
    condition a task instead (see :func:`hash_predicates` for text keys). A read by a
    single task must be chosen with ``unsplit``. Filters and column selections on the
    result are pushed to the database.
    """
    if split_on is None and not predicates and not unsplit:
        raise ValueError("give split_on or predicates, or choose unsplit")

    def load(**options: str) -> DataFrame:
        reader = spark.read.format("jdbc").option("fetchsize", FETCH_ROWS)
        return reader.options(**db.options(), **options).load()

    if predicates:
        options = {"fetchsize": FETCH_ROWS, **db.options()}
        url = options.pop("url")
        named = {k: str(v) for k, v in options.items()}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=named)
    if split_on is None:
        return load(dbtable=table)
    ends = f"SELECT MIN({split_on}) AS lo, MAX({split_on}) AS hi FROM {table}"
    low, high = load(query=ends).first()
    if low is None:
        return load(dbtable=table)
    return load(**range_options(table, split_on, low, high, splits))


# A database's own hash of a text column. Hashes of 32 bits are widened
# before ABS, which overflows on the smallest value.
HASHES = {
    "mysql": "MOD(CRC32({column}), {n})",
    "postgresql": "MOD(ABS(CAST(HASHTEXT(CAST({column} AS TEXT)) AS BIGINT)), {n})",
    "oracle": "ORA_HASH({column}, {n} - 1)",
    "sqlserver": "ABS(CAST(CHECKSUM({column}) AS BIGINT)) % {n}",
}


def hash_predicates(kind: str, column: str, splits: int) -> list[str]:
    """Conditions that deal rows out by the hash of a column; nulls go to the first."""
    if kind not in HASHES:
        raise ValueError(f"{kind} has no hash function to split on")
    value = HASHES[kind].format(column=column, n=splits)
    rest = [f"{value} = {i}" for i in range(splits)]
    return [f"{rest[0]} OR {column} IS NULL", *rest[1:]]


def range_options(
    table: str,
    split_on: str,
    low: int | Decimal | date,
    high: int | Decimal | date,
    splits: int,
) -> dict[str, str]:
    """Options of a ranged read; the last range includes the highest value."""
    if isinstance(low, datetime):
        first, last = str(low), str(high + timedelta(seconds=1))
    elif isinstance(low, date):
        first, last = str(low), str(high + timedelta(days=1))
    elif isinstance(low, int | float | Decimal):
        first, last = str(int(low)), str(int(high) + 1)
    else:
        raise TypeError(f"{split_on} is no number or time: use hash_predicates")
    return {
        "dbtable": table,
        "partitionColumn": split_on,
        "lowerBound": first,
        "upperBound": last,
        "numPartitions": str(splits),
    }
