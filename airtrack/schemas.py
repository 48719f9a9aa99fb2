"""Record schemas as DDL strings."""

JM_DRONE_FIELDS = (
    ("batch_num", "string"),
    ("detect_type", "int"),
    ("drone_uuid", "string"),
    ("frequency", "double"),
    ("height", "double"),
    ("intrusion_start_time", "string"),
    ("lasting_time", "int"),
    ("latitude", "double"),
    ("longitude", "double"),
    ("model", "string"),
    ("scanID", "string"),
    ("speed", "double"),
    ("type", "int"),
)

# The message and its elements as text fields: elements are parsed one by one and every number is cast by the
# operator that needs it, so one bad field or element never hides the others.
JM_MESSAGE = "station_id string, drone array<string>"
JM_ELEMENT = ", ".join(f"{name} string" for name, _ in JM_DRONE_FIELDS)

JM_OLD_FIELDS = (
    ("intrusion_start_time", "string"),
    ("latitude", "double"),
    ("target_type", "int"),
    ("droneUK", "string"),
    ("batch_num", "string"),
    ("speed", "double"),
    ("frequency", "double"),
    ("driver_longitude", "double"),
    ("lasting_time", "int"),
    ("data_type", "int"),
    ("model", "string"),
    ("driver_latitude", "double"),
    ("longitude", "double"),
    ("height", "double"),
    ("timestamp", "bigint"),
)

AOA_FIELDS = (
    ("devId", "string"),
    ("batchno", "string"),
    ("distance", "double"),
    ("lasting_time", "int"),
    ("channel", "double"),
    ("model", "string"),
    ("direction", "double"),
    ("timestamp", "bigint"),
)

TDOA = (
    "gpsLongitude double, gpsLatitude double, longitude double, latitude double, lastCoorDate string, "
    "frequency double, height double, speed double, lastingTime int"
)

ODS_JM_COLUMNS = (
    "batch_num string, detect_type int, drone_uuid string, frequency double, height double, "
    "intrusion_start_time string, lasting_time int, latitude double, longitude double, model string, "
    "scanid string, speed double, type int, station_id string, `timestamp` bigint, dt string, hr string"
)

ODS_AOA_COLUMNS = (
    "devId string, batchno string, distance double, lasting_time bigint, channel double, model string, "
    "direction double, `timestamp` bigint, dt string, hr string"
)

ODS_JM_OLD_COLUMNS = (
    "intrusion_start_time string, latitude double, target_type int, droneUK string, batch_num string, "
    "speed double, frequency double, driver_longitude double, lasting_time int, data_type int, "
    "model string, driver_latitude double, longitude double, height double, `timestamp` bigint, "
    "dt string, hr string"
)

FEATURE = (
    "struct<signal_id:string,lat_range:double,lon_range:double,time_range:int,avg_speed:double,avg_height:double>"
)

DWD = (
    "batch_num string, detect_type int, drone_uuid string, frequency double, height double, "
    "intrusion_start_time string, lasting_time int, latitude double, longitude double, model string, "
    "scanID array<struct<id:string>>, speed double, type int, driverlongitude double, driverlatitude double, "
    "station_id string, signal_id string, timestamp bigint, event_time bigint, utm_x double, utm_y double, "
    "heading double, curr_batch_time string, curr_batch_first int, start_latitude double, "
    f"start_longitude double, start_height double, feature {FEATURE}, pre_fusion_id string, "
    "pre_fusion_start_time string, pre_fusion_longitude double, pre_fusion_latitude double, "
    "pre_fusion_height double, fusion_id string, fusion_start_time string, fusion_longitude double, "
    "fusion_latitude double, fusion_height double"
)
