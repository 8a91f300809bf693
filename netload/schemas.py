"""Column contracts, as DDL so that readers never need an inference pass."""

# Field names, order and types of the telemetry record, the cell
# dimension and the delivered result.
TELEMETRY = (
    "ts STRING, cell_id STRING, niveau STRING, event STRING, "
    "connexions_actives BIGINT, latence_ms BIGINT, octets BIGINT"
)
CELL = (
    "cell_id STRING, secteur STRING, techno STRING, capacite_max BIGINT, "
    "lat DOUBLE, lon DOUBLE, mise_en_service STRING"
)
SATURATION = (
    "cell_id STRING, secteur STRING, techno STRING, heure INT, "
    "connexions_moy DOUBLE, capacite_max BIGINT, taux_charge DOUBLE"
)

# Columns used of the given star-schema tables.
TABLES = {
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
        "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
}

CORRUPT = "_corrupt_record"
# 1 for rows of the stored table whose line the parser refused; a folder level.
REFUSED = "_refusee"


def names(ddl: str) -> list[str]:
    """Field names of a flat DDL string, in order."""
    return [field.split()[0] for field in ddl.split(",")]


def with_rejects(ddl: str) -> str:
    """The same record plus the column that keeps a line the parser refused."""
    return f"{ddl}, {CORRUPT} STRING"
