def plan(frame) -> str:
    """The physical plan as ``explain`` prints it."""
    return frame._jdf.queryExecution().executedPlan().toString()


def values(frame, *columns):
    """Rows as a sorted list of tuples."""
    rows = frame.select(*columns).collect() if columns else frame.collect()
    return sorted(map(tuple, rows), key=repr)


def telemetry(spark, rows):
    """(cell_id, heure, connexions_actives) rows."""
    return spark.createDataFrame(rows, "cell_id STRING, heure INT, connexions_actives BIGINT")


def cells(spark, rows):
    """(cell_id, secteur, techno, capacite_max) rows."""
    return spark.createDataFrame(rows, "cell_id STRING, secteur STRING, techno STRING, capacite_max BIGINT")
