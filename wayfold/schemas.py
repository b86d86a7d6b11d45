"""Declared schemas. Nothing is inferred from data.

Fixed values: the names and types of waypoints, positions and labelled points are the wire and table formats.
"""

from pyspark.sql import types as T

WAYPOINT = T.StructType(
    [
        T.StructField("vehicle", T.StringType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("datetime", T.LongType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("ignition", T.BooleanType()),
        T.StructField("working", T.BooleanType()),
        T.StructField("door_up", T.BooleanType()),
        T.StructField("door_down", T.BooleanType()),
    ]
)

# Fixed value: the name of the wrapper object in archived records.
WRAPPER = "msgBusWayPoint"

# A record is either wrapped or flat; one read accepts both.
ANY_RECORD = T.StructType([T.StructField(WRAPPER, WAYPOINT), *WAYPOINT.fields])

ROUTE = T.StructType(
    [
        T.StructField("vehicle", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("route_no", T.StringType()),
    ]
)

STOP = T.StructType(
    [
        T.StructField("stop_x", T.DoubleType()),
        T.StructField("stop_y", T.DoubleType()),
    ]
)

POSITION = T.StructType(
    [
        T.StructField("bus_id", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("route_no", T.StringType()),
    ]
)

WAYPOINT_COLUMNS = [f.name for f in WAYPOINT.fields]
POSITION_COLUMNS = [f.name for f in POSITION.fields]
LABELLED_COLUMNS = [
    "vehicle",
    "x",
    "y",
    "speed",
    "event_ts",
    "grid_id",
    "cluster_id",
    "congestion_status",
    "tti",
    "severity",
    "buffer_size",
]
