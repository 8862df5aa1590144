"""DuckDB SQL that states each registered query independently.

Rounded values go through DECIMAL, which rounds halves away from zero as Spark does on doubles.
"""

from __future__ import annotations

from furrow.sources.sensor_views import RAW_READINGS, READINGS, REGISTERED, RESENT


def _round(value: str) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38, 12)), 2) AS DOUBLE)"


def _select(columns: tuple[str, ...]) -> str:
    return ",\n    ".join(columns)


_READING = "reading_id, sensor_id, farm_id, field_id, timestamp, temperature, humidity, soil_moisture, rainfall, battery"
_FLAG = (
    "sensor_id_valid, timestamp_valid, temperature_valid, humidity_valid, soil_moisture_valid, "
    "rainfall_valid, battery_valid"
)

# Common table expressions, each with those it needs.
_CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "readings": ((), f"SELECT {_select(READINGS)} FROM events"),
    "registry": ((), f"SELECT DISTINCT c_custkey AS known_id FROM customer WHERE {REGISTERED}"),
    "farms": ((), "SELECT n_nationkey AS farm_key, n_name AS farm_name, n_regionkey AS region_id FROM nation"),
    "raw": ((), f"SELECT {_select(RAW_READINGS)} FROM events"),
    "cleaned": (("raw",), """
        SELECT reading_id, trim(sensor_id) AS sensor_id, trim(farm_id) AS farm_id, field_id,
            try_strptime(timestamp, '%d-%m-%Y %H:%M') AS timestamp,
            TRY_CAST(temperature AS DOUBLE) AS temperature, TRY_CAST(humidity AS DOUBLE) AS humidity,
            TRY_CAST(soil_moisture AS DOUBLE) AS soil_moisture, TRY_CAST(rainfall AS DOUBLE) AS rainfall,
            TRY_CAST(battery AS DOUBLE) AS battery
        FROM raw"""),
    "member": (("readings", "registry"), """
        SELECT r.*, g.known_id IS NOT NULL AS sensor_id_valid
        FROM readings r LEFT JOIN registry g ON r.sensor_id = g.known_id"""),
    "flagged": (("member",), """
        SELECT *, timestamp IS NOT NULL AS timestamp_valid,
            coalesce(temperature BETWEEN -10 AND 60, FALSE) AS temperature_valid,
            coalesce(humidity BETWEEN 0 AND 100, FALSE) AS humidity_valid,
            coalesce(soil_moisture BETWEEN 0 AND 100, FALSE) AS soil_moisture_valid,
            coalesce(rainfall >= 0, FALSE) AS rainfall_valid,
            coalesce(battery BETWEEN 0 AND 100, FALSE) AS battery_valid
        FROM member"""),
    "checked": (("flagged",), f"""
        SELECT *, {_FLAG.replace(', ', ' AND ')} AS is_valid,
            concat_ws('; ',
                CASE WHEN NOT sensor_id_valid THEN 'INVALID_SENSOR_ID' END,
                CASE WHEN NOT timestamp_valid THEN 'INVALID_TIMESTAMP' END,
                CASE WHEN NOT temperature_valid THEN 'INVALID_TEMPERATURE_RANGE' END,
                CASE WHEN NOT humidity_valid THEN 'INVALID_HUMIDITY_RANGE' END,
                CASE WHEN NOT soil_moisture_valid THEN 'INVALID_SOIL_MOISTURE_RANGE' END,
                CASE WHEN NOT rainfall_valid THEN 'INVALID_RAINFALL' END,
                CASE WHEN NOT battery_valid THEN 'INVALID_BATTERY_RANGE' END) AS invalid_reason
        FROM flagged"""),
    "trusted": (("checked",), f"""
        SELECT {_READING}, {_FLAG}, is_valid, invalid_reason, CAST(timestamp AS DATE) AS reading_date
        FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, farm_id, timestamp
                                           ORDER BY reading_id) AS copy
              FROM checked WHERE is_valid)
        WHERE copy = 1"""),
    "resent": (("readings",), f"""
        SELECT reading_id, sensor_id, farm_id, timestamp, temperature, 1 AS ingest_seq FROM readings
        UNION ALL
        SELECT r.reading_id, r.sensor_id, r.farm_id, r.timestamp, r.temperature + 0.25e0, 2
        FROM readings r JOIN events e ON r.reading_id = e.event_id WHERE e.{RESENT}"""),
    "sensor_trend": (("trusted",), """
        SELECT *, lag(temperature) OVER w AS previous_temperature,
            lag(soil_moisture) OVER w AS previous_soil_moisture,
            avg(temperature) OVER w3 AS temperature_rolling_avg,
            avg(humidity) OVER w3 AS humidity_rolling_avg,
            avg(soil_moisture) OVER w3 AS soil_moisture_rolling_avg,
            avg(rainfall) OVER w3 AS rainfall_rolling_avg
        FROM trusted
        WINDOW w AS (PARTITION BY sensor_id ORDER BY timestamp, reading_id),
            w3 AS (PARTITION BY sensor_id ORDER BY timestamp, reading_id
                   ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
    "pair_trend": (("trusted",), f"""
        SELECT *, {_round('temperature - previous_temperature')} AS temperature_change,
            {_round('mean_of_three')} AS three_reading_average
        FROM (SELECT *, lag(temperature) OVER w AS previous_temperature,
                  avg(temperature) OVER (PARTITION BY farm_id, sensor_id ORDER BY timestamp, reading_id
                                         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mean_of_three
              FROM trusted
              WINDOW w AS (PARTITION BY farm_id, sensor_id ORDER BY timestamp, reading_id))"""),
    "interacted": (("sensor_trend",), """
        SELECT *, temperature * humidity AS temperature_humidity_interaction,
            soil_moisture * rainfall AS soil_rainfall_interaction,
            abs(temperature - humidity) AS temperature_humidity_difference,
            CASE WHEN soil_moisture < 30 THEN 30 - soil_moisture ELSE 0e0 END AS soil_moisture_deficit,
            CAST(CASE WHEN soil_moisture < 30 AND rainfall < 2 THEN 1 ELSE 0 END AS INTEGER) AS irrigation_label
        FROM sensor_trend"""),
    "featured": (("interacted",), """
        SELECT reading_id, sensor_id, farm_id, timestamp, temperature, humidity, soil_moisture, rainfall, battery,
            CAST(hour(timestamp) AS INTEGER) AS reading_hour,
            CAST(dayofweek(timestamp) + 1 AS INTEGER) AS day_of_week,
            CAST(month(timestamp) AS INTEGER) AS month,
            CAST(day(timestamp) AS INTEGER) AS day_of_month,
            temperature_humidity_interaction, soil_rainfall_interaction,
            temperature_humidity_difference, soil_moisture_deficit,
            coalesce(temperature - previous_temperature, 0) AS temperature_change,
            coalesce(soil_moisture - previous_soil_moisture, 0) AS soil_moisture_change,
            temperature_rolling_avg, humidity_rolling_avg, soil_moisture_rolling_avg,
            rainfall_rolling_avg, irrigation_label
        FROM interacted"""),
    "moisture": (("trusted",), """
        SELECT reading_id, farm_id, timestamp, temperature, humidity, soil_moisture, rainfall, battery,
            lag(soil_moisture, 1) OVER w AS soil_moisture_lag_1,
            lag(soil_moisture, 2) OVER w AS soil_moisture_lag_2,
            lag(soil_moisture, 3) OVER w AS soil_moisture_lag_3,
            avg(soil_moisture) OVER p AS soil_moisture_rolling_avg_3,
            avg(temperature) OVER p AS temperature_rolling_avg_3,
            avg(humidity) OVER p AS humidity_rolling_avg_3,
            lead(soil_moisture) OVER w AS next_hour_soil_moisture,
            CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS reading_hour,
            CAST(hour(timestamp) AS INTEGER) AS hour,
            CAST(dayofweek(timestamp) + 1 AS INTEGER) AS day_of_week,
            CAST(month(timestamp) AS INTEGER) AS month
        FROM trusted
        WINDOW w AS (PARTITION BY farm_id ORDER BY timestamp, reading_id),
            p AS (PARTITION BY farm_id ORDER BY timestamp, reading_id
                  ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"""),
    "dataset": (("moisture",), """
        SELECT * FROM moisture
        WHERE soil_moisture_lag_3 IS NOT NULL AND next_hour_soil_moisture IS NOT NULL
            AND soil_moisture_lag_1 IS NOT NULL AND soil_moisture_lag_2 IS NOT NULL
            AND soil_moisture_rolling_avg_3 IS NOT NULL AND temperature_rolling_avg_3 IS NOT NULL
            AND humidity_rolling_avg_3 IS NOT NULL AND temperature IS NOT NULL AND humidity IS NOT NULL
            AND rainfall IS NOT NULL AND battery IS NOT NULL"""),
    "split_dataset": (("dataset",), """
        SELECT *, CASE WHEN ordinal <= floor(count(*) OVER () * 0.8e0) THEN 'train' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (ORDER BY timestamp, reading_id) AS ordinal FROM dataset)"""),
    "hash_split": (("trusted",), """
        SELECT reading_id, sensor_id, farm_id,
            CASE WHEN substr(md5(concat('42:', CAST(reading_id AS VARCHAR))), 1, 4) < 'cccd'
                THEN 'train' ELSE 'test' END AS split
        FROM trusted"""),
}

_DAILY = f"""
    SELECT farm_id, CAST(timestamp AS DATE) AS reading_date, count(reading_id) AS total_readings,
        count(DISTINCT sensor_id) AS active_sensors,
        {_round('avg(temperature)')} AS avg_temperature, {_round('min(temperature)')} AS min_temperature,
        {_round('max(temperature)')} AS max_temperature, {_round('avg(humidity)')} AS avg_humidity,
        {_round('avg(soil_moisture)')} AS avg_soil_moisture, {_round('sum(rainfall)')} AS total_rainfall,
        {_round('avg(battery)')} AS avg_battery
    FROM trusted GROUP BY ALL"""

_TEMPERATURE = "CASE WHEN {0} >= 40 THEN 'HIGH' WHEN {0} <= 5 THEN 'LOW' ELSE 'NORMAL' END"
_BAND = "CASE WHEN {0} < 30 THEN 'LOW' WHEN {0} > 80 THEN 'HIGH' ELSE 'NORMAL' END"
_DRY = "CASE WHEN {0} < 30 AND {1} < 2 THEN '{2}' ELSE '{3}' END"
_HEALTH = "CASE WHEN {0} < 20 THEN 'LOW_BATTERY' WHEN {1} < 50 THEN 'WARNING' ELSE 'HEALTHY' END"

_STATUSES = ",\n    ".join((
    _TEMPERATURE.format("temperature") + " AS temperature_status",
    _BAND.format("soil_moisture") + " AS soil_status",
    _BAND.format("humidity") + " AS humidity_status",
    _DRY.format("soil_moisture", "rainfall", "IRRIGATION_REQUIRED", "NO_IRRIGATION_REQUIRED")
    + " AS irrigation_required",
    _HEALTH.format("battery", "battery") + " AS sensor_health",
))

_FARM_DAILY = f"""
    SELECT *, {_TEMPERATURE.format('avg_temperature')} AS temperature_status,
        {_BAND.format('avg_soil_moisture')} AS soil_status,
        {_DRY.format('avg_soil_moisture', 'total_rainfall', 'YES', 'NO')} AS irrigation_required
    FROM ({_DAILY})"""

_SENSOR_HEALTH = f"""
    SELECT *, {_HEALTH.format('min_battery', 'avg_battery')} AS sensor_health
    FROM (SELECT farm_id, sensor_id, count(reading_id) AS total_readings,
              min(timestamp) AS first_reading_timestamp, max(timestamp) AS last_reading_timestamp,
              {_round('avg(battery)')} AS avg_battery, {_round('min(battery)')} AS min_battery,
              {_round('avg(temperature)')} AS avg_temperature
          FROM trusted GROUP BY farm_id, sensor_id)"""

_ALERTS = f"""
    SELECT farm_id, sensor_id, timestamp, reading_date,
        CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS reading_hour,
        temperature, humidity, soil_moisture, rainfall, battery,
        {_BAND.format('soil_moisture')} AS soil_status, 'YES' AS irrigation_required,
        'IRRIGATION_ALERT' AS alert_status
    FROM trusted WHERE soil_moisture < 30 AND rainfall < 2"""

_CROPS = f"""
    SELECT farm_id, reading_date, avg_temperature, avg_humidity, avg_soil_moisture, total_rainfall,
        {_TEMPERATURE.format('avg_temperature')} AS temperature_status,
        {_BAND.format('avg_humidity')} AS humidity_status, {_BAND.format('avg_soil_moisture')} AS soil_status
    FROM ({_DAILY})"""


def _cents(value: str) -> str:
    return _round(f"(avg(CAST(round(coalesce({value}, 0) * 100) AS BIGINT)) / 100)")


_TREND = f"""
    SELECT h.*, coalesce(d.t_avg, 0) AS daily_temperature_avg, coalesce(d.t_min, 0) AS daily_temperature_min,
        coalesce(d.t_max, 0) AS daily_temperature_max
    FROM (SELECT farm_id, sensor_id, CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS reading_hour,
              reading_date, {_round('avg(coalesce(temperature, 0))')} AS avg_temperature,
              {_round('avg(coalesce(humidity, 0))')} AS avg_humidity,
              {_round('avg(coalesce(soil_moisture, 0))')} AS avg_soil_moisture,
              {_round('avg(coalesce(rainfall, 0))')} AS avg_rainfall,
              {_round('avg(coalesce(battery, 0))')} AS avg_battery,
              {_cents('temperature_change')} AS avg_temperature_change,
              {_cents('three_reading_average')} AS three_reading_temperature_avg
          FROM pair_trend GROUP BY ALL) h
    LEFT JOIN (SELECT farm_id, reading_date, {_round('avg(temperature)')} AS t_avg,
                   {_round('min(temperature)')} AS t_min, {_round('max(temperature)')} AS t_max
               FROM trusted GROUP BY ALL) d
    ON h.farm_id IS NOT DISTINCT FROM d.farm_id AND h.reading_date IS NOT DISTINCT FROM d.reading_date"""

_MARTS = {
    "farm_daily_metrics": _FARM_DAILY,
    "sensor_health": _SENSOR_HEALTH,
    "irrigation_alerts": _ALERTS,
    "crop_conditions": _CROPS,
    "environment_trend": _TREND,
}
_CENSUS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS record_count, CAST(NULL AS VARCHAR) AS error FROM ({body})"
    for name, body in _MARTS.items()
) + " UNION ALL SELECT 'never_written', NULL, 'TABLE_OR_VIEW_NOT_FOUND'"

_DAILY_STATS = (
    "SELECT reading_id, sensor_id, farm_id, reading_date, temperature, {avg} AS daily_average,"
    " {min} AS daily_min, {max} AS daily_max FROM trusted WINDOW w AS (PARTITION BY {key}, reading_date)"
)
_OVER = {f: f"{f}(temperature) OVER w" for f in ("avg", "min", "max")}

# ---- Fixed values: the models' inputs, in vector order ----
_IRRIGATION_VECTOR = (
    "temperature", "humidity", "soil_moisture", "rainfall", "battery",
    "reading_hour", "day_of_week", "month", "day_of_month",
    "temperature_humidity_interaction", "soil_rainfall_interaction",
    "temperature_humidity_difference", "soil_moisture_deficit",
    "temperature_change", "soil_moisture_change",
    "temperature_rolling_avg", "humidity_rolling_avg",
    "soil_moisture_rolling_avg", "rainfall_rolling_avg",
)
_MOISTURE_VECTOR = (
    "temperature", "humidity", "rainfall", "battery",
    "soil_moisture_lag_1", "soil_moisture_lag_2", "soil_moisture_lag_3",
    "soil_moisture_rolling_avg_3", "temperature_rolling_avg_3", "humidity_rolling_avg_3",
    "hour", "day_of_week", "month",
)

# ---- Fixed values: columns of the trusted and of the cleaned readings, with their types ----
_TRUSTED_TYPES = (
    ("reading_id", "bigint"), ("sensor_id", "bigint"), ("farm_id", "bigint"), ("field_id", "bigint"),
    ("timestamp", "timestamp"), ("temperature", "double"), ("humidity", "double"), ("soil_moisture", "double"),
    ("rainfall", "double"), ("battery", "double"), ("sensor_id_valid", "boolean"), ("timestamp_valid", "boolean"),
    ("temperature_valid", "boolean"), ("humidity_valid", "boolean"), ("soil_moisture_valid", "boolean"),
    ("rainfall_valid", "boolean"), ("battery_valid", "boolean"), ("is_valid", "boolean"), ("invalid_reason", "string"),
    ("reading_date", "date"),
)
_CLEANED_TYPES = tuple((n, "string" if n.endswith("_id") and n != "reading_id" else kind) for n, kind in _TRUSTED_TYPES[:10])


def _vector(names: tuple[str, ...]) -> str:
    return ", ".join(
        [f"CAST({len(names)} AS INTEGER) AS n_features"] + [f"CAST({n} AS DOUBLE) AS v_{n}" for n in names]
    )


_BY_TIME = """
    SELECT farm_id, reading_hour, soil_moisture,
        avg(soil_moisture) OVER (w RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS soil_moisture_lag_1,
        avg(soil_moisture) OVER (w RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND INTERVAL 2 HOUR PRECEDING) AS soil_moisture_lag_2,
        avg(soil_moisture) OVER (w RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND INTERVAL 3 HOUR PRECEDING) AS soil_moisture_lag_3,
        avg(soil_moisture) OVER (w RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS soil_moisture_rolling_avg_3,
        avg(temperature) OVER (w RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS temperature_rolling_avg_3,
        avg(humidity) OVER (w RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS humidity_rolling_avg_3,
        avg(soil_moisture) OVER (w RANGE BETWEEN INTERVAL 1 HOUR FOLLOWING AND INTERVAL 1 HOUR FOLLOWING) AS next_hour_soil_moisture,
        CAST(hour(reading_hour) AS INTEGER) AS hour, CAST(dayofweek(reading_hour) + 1 AS INTEGER) AS day_of_week,
        CAST(month(reading_hour) AS INTEGER) AS month
    FROM (SELECT farm_id, CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS reading_hour, avg(temperature) AS temperature,
              avg(humidity) AS humidity, avg(soil_moisture) AS soil_moisture
          FROM trusted GROUP BY ALL)
    WINDOW w AS (PARTITION BY farm_id ORDER BY reading_hour)"""

_QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "csv_scan": (("raw",), """
        SELECT reading_id, sensor_id, farm_id, field_id, timestamp,
            nullif(temperature, '') AS temperature, humidity, soil_moisture, rainfall, battery
        FROM raw"""),
    "csv_scan_inferred": ((), """
        SELECT c_custkey AS sensor_id, c_name AS sensor_name, c_nationkey AS farm_id FROM customer"""),
    "bronze_audit": (("raw",), "SELECT reading_id, TRUE AS has_load_time, TRUE AS has_source_file FROM raw"),
    "table_overwrite": (("readings",), """
        SELECT reading_id, timestamp, temperature, humidity, soil_moisture, rainfall, battery FROM readings"""),
    "table_rewrite_fill": (("readings",), """
        SELECT reading_id, sensor_id, farm_id, coalesce(temperature, 0e0) AS temperature,
            humidity, soil_moisture, rainfall, battery
        FROM readings"""),
    "quarantine_append": (("checked",), f"""
        SELECT {_READING}, CAST(NULL AS BOOLEAN) AS is_valid, invalid_reason, 'QUARANTINED' AS quarantine_status
        FROM checked WHERE NOT is_valid
        UNION ALL
        SELECT {_READING}, is_valid, 'NULL_OR_MISSING_REQUIRED_FIELD', 'QUARANTINED'
        FROM checked WHERE reading_id IS NULL OR sensor_id IS NULL
            OR farm_id IS NULL OR field_id IS NULL OR timestamp IS NULL OR temperature IS NULL
            OR humidity IS NULL OR soil_moisture IS NULL OR rainfall IS NULL OR battery IS NULL"""),
    "layer_census": (("pair_trend",), _CENSUS),
    "table_list": (("trusted", "farms"), """
        SELECT 'farm_master' AS table_name, count(*) AS record_count FROM farms
        UNION ALL SELECT 'valid_sensor', count(*) FROM trusted"""),
    "membership_mixed_types": (("readings", "registry"), """
        SELECT reading_id, sensor_id,
            coalesce(sensor_id IN (SELECT CAST(known_id AS VARCHAR) FROM registry), FALSE) AS sensor_id_valid
        FROM (SELECT reading_id, CASE WHEN reading_id % 11 = 0 THEN concat('x', CAST(sensor_id AS VARCHAR))
                  WHEN reading_id % 13 = 0 THEN NULL ELSE CAST(sensor_id AS VARCHAR) END AS sensor_id
              FROM readings)"""),
    "farm_enrich_mixed_types": (("trusted", "farms"), """
        SELECT t.reading_id, t.farm_id, f.farm_name, f.region_id
        FROM (SELECT reading_id, CASE WHEN reading_id % 11 = 0 THEN 'n/a' ELSE CAST(farm_id AS VARCHAR) END AS farm_id
              FROM trusted) t LEFT JOIN farms f ON t.farm_id = CAST(f.farm_key AS VARCHAR)"""),
    "missing_partition": (("readings",), """
        SELECT reading_id, CASE WHEN reading_id % 17 = 0 OR reading_id IS NULL OR sensor_id IS NULL
                OR farm_id IS NULL OR field_id IS NULL OR timestamp IS NULL OR temperature IS NULL
                OR humidity IS NULL OR soil_moisture IS NULL OR rainfall IS NULL OR battery IS NULL
            THEN 'quarantined' ELSE 'kept' END AS side
        FROM readings"""),
    "quarantine_refresh": (("checked",), """
        SELECT reading_id, invalid_reason, CASE WHEN NOT is_valid THEN 'QUARANTINED' END AS quarantine_status
        FROM checked"""),
    "irrigation_features_hot": (("featured",), "SELECT * FROM featured"),
    "next_moisture_features_hot": (("moisture",), "SELECT * FROM moisture"),
    "forest_repartition_check": (("hash_split",), """
        SELECT count(*) AS records, CAST(0 AS BIGINT) AS differing, CAST(0 AS BIGINT) AS differing_trees
        FROM hash_split WHERE split = 'test'"""),
    "bootstrap_weights": (("hash_split",), """
        SELECT count(*) AS records, TRUE AS mean_is_one, TRUE AS variance_is_one, TRUE AS draws_differ
        FROM hash_split WHERE split = 'train'"""),
    "irrigation_predictions_check": (("hash_split",), """
        SELECT reading_id, CAST(2 AS INTEGER) AS n_labels, TRUE AS sums_to_one, TRUE AS is_most_likely
        FROM hash_split WHERE split = 'test'"""),
    "irrigation_classifier_check": (("hash_split",), """
        SELECT split, count(*) AS records, TRUE AS beats_majority FROM hash_split GROUP BY split"""),
    "feature_importance_check": ((), """
        SELECT CAST(19 AS BIGINT) AS features, CAST(0 AS BIGINT) AS negative, 1e0 AS total"""),
    "training_summary_check": (("hash_split",), """
        SELECT count(*) AS total_records, count(*) FILTER (split = 'train') AS train_records,
            count(*) FILTER (split = 'test') AS test_records, TRUE AS same_accuracy
        FROM hash_split"""),
    "moisture_predictions_check": (("split_dataset",), """
        SELECT reading_id, TRUE AS call_agrees, TRUE AS within_targets FROM split_dataset WHERE split = 'test'"""),
    "moisture_training_summary_check": (("split_dataset",), """
        SELECT count(*) AS total_records, count(*) FILTER (split = 'train') AS train_records,
            count(*) FILTER (split = 'test') AS test_records, TRUE AS same_mae, TRUE AS learned
        FROM split_dataset"""),
    "schema_profile": (("trusted",), " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS ordinal, '{name}' AS column_name, '{kind}' AS data_type, TRUE AS nullable,
            count(*) AS rows, count({name}) AS present, CAST(0 AS BIGINT) AS nan, CAST(min({name}) AS VARCHAR) AS least,
            CAST(max({name}) AS VARCHAR) AS greatest, count(DISTINCT {name}) > 0 AS about_distinct FROM trusted"""
        for i, (name, kind) in enumerate(_TRUSTED_TYPES, 1))),
    "schema_profile_raw": (("cleaned",), " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS ordinal, '{name}' AS column_name, '{kind}' AS data_type,
            count(*) AS rows, count({name}) AS present, CAST(0 AS BIGINT) AS nan, CAST(min({name}) AS VARCHAR) AS least,
            CAST(max({name}) AS VARCHAR) AS greatest FROM cleaned"""
        for i, (name, kind) in enumerate(_CLEANED_TYPES, 1))),
    "csv_scan_checked": (("readings",), """
        SELECT CASE WHEN fits THEN reading_id END AS reading_id, CASE WHEN fits THEN sensor_id END AS sensor_id,
            CASE WHEN fits THEN farm_id END AS farm_id, CASE WHEN fits THEN soil_moisture END AS soil_moisture,
            CASE reading_id % 50
                WHEN 7 THEN concat_ws(',', reading_id, sensor_id, farm_id)
                WHEN 8 THEN concat_ws(',', reading_id, sensor_id, farm_id, soil_moisture, 'extra')
                WHEN 9 THEN concat_ws(',', reading_id, sensor_id, farm_id, 'wet') END AS rejected_line
        FROM (SELECT *, reading_id % 50 NOT IN (7, 8, 9) AS fits FROM readings)"""),
    "table_refresh_day": (("readings",), """
        SELECT reading_id, sensor_id, farm_id, timestamp, CAST(timestamp AS DATE) AS reading_date,
            CASE WHEN CAST(timestamp AS DATE) = (SELECT max(CAST(timestamp AS DATE)) FROM readings)
                THEN coalesce(temperature, 0) + 1 ELSE temperature END AS temperature
        FROM readings"""),
    "next_hour_by_time": (("trusted",), _BY_TIME),
    "next_hour_by_time_plain": (("trusted",), _BY_TIME),
    "hour_around_sensor": (("trusted",), """
        SELECT reading_id, sensor_id, farm_id, timestamp, temperature,
            avg(temperature) OVER (PARTITION BY sensor_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING) AS day_before,
            avg(temperature) OVER (PARTITION BY sensor_id ORDER BY sec RANGE BETWEEN 1 FOLLOWING AND 3600 FOLLOWING) AS hour_after
        FROM (SELECT *, CAST(epoch(date_trunc('second', timestamp)) AS BIGINT) AS sec FROM trusted)"""),
    "incremental_landing": (("raw",), """
        SELECT reading_id, sensor_id, farm_id, field_id, timestamp, nullif(temperature, '') AS temperature, humidity,
            soil_moisture, rainfall, battery, CAST(0 AS INTEGER) AS files_in_last_load
        FROM raw"""),
    "strongest_features": (("featured",), "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{name}' AS feature_name, CASE WHEN stddev_pop({name}) > 0 THEN round(abs(
                covar_pop({name}, irrigation_label) / (stddev_pop({name}) * stddev_pop(irrigation_label))), 9) END AS strength
            FROM featured"""
        for name in _IRRIGATION_VECTOR) + ") ORDER BY strength DESC NULLS LAST, feature_name LIMIT 5"),
    "predictions_preview_of_mean": (("dataset",), f"""
        SELECT farm_id, reading_hour, temperature, humidity, soil_moisture, rainfall, battery,
            next_hour_soil_moisture, {_round('soil_moisture_rolling_avg_3')} AS predicted_next_hour_soil_moisture,
            CASE WHEN soil_moisture_rolling_avg_3 < 30 THEN 'YES' ELSE 'NO' END AS predicted_irrigation_required
        FROM dataset ORDER BY farm_id, reading_hour, reading_id LIMIT 50"""),
    "column_guard": (("trusted",), """
        SELECT reading_id, 'missing required columns: [''rainfall'', ''battery'']' AS refusal FROM trusted"""),
    "too_few_rows": (("dataset",), """
        SELECT count(*) AS records,
            concat('not enough rows to train: ', count(*), ', at least ', count(*) + 1, ' needed') AS refusal
        FROM dataset"""),
    "quarantine_append_day": (("readings",), "SELECT reading_id, sensor_id, farm_id, timestamp FROM readings"),
    "refine_in_one_pass": (("checked",), """
        SELECT reading_id, invalid_reason, CASE WHEN NOT is_valid THEN 'QUARANTINED' END AS quarantine_status,
            count(*) FILTER (is_valid) OVER () AS valid_records,
            count(*) FILTER (NOT is_valid) OVER () AS invalid_records, count(*) OVER () AS total_records
        FROM checked"""),
    "clean_readings": (("cleaned",), "SELECT * FROM cleaned"),
    "parse_timestamp": (("raw",), """
        SELECT reading_id, timestamp AS text, try_strptime(timestamp, '%d-%m-%Y %H:%M') AS timestamp FROM raw"""),
    "time_parts": (("trusted",), """
        SELECT reading_id, timestamp, reading_date,
            CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS hour_start,
            CAST(hour(timestamp) AS INTEGER) AS hour, CAST(dayofweek(timestamp) + 1 AS INTEGER) AS day_of_week,
            CAST(month(timestamp) AS INTEGER) AS month, CAST(day(timestamp) AS INTEGER) AS day_of_month
        FROM trusted"""),
    "distinct_sensors": (("readings",), "SELECT DISTINCT sensor_id FROM readings"),
    "sensor_membership": (("member",), "SELECT * FROM member"),
    "validation_flags": (("checked",), f"SELECT reading_id, sensor_id, farm_id, {_FLAG}, is_valid FROM checked"),
    "invalid_reason": (("checked",), "SELECT reading_id, is_valid, invalid_reason FROM checked"),
    "valid_readings": (("checked",), "SELECT * FROM checked WHERE is_valid"),
    "quarantine": (("checked",), "SELECT *, 'QUARANTINED' AS quarantine_status FROM checked WHERE NOT is_valid"),
    "required_not_null": (("cleaned",), """
        SELECT * FROM cleaned
        WHERE reading_id IS NOT NULL AND sensor_id IS NOT NULL AND farm_id IS NOT NULL AND field_id IS NOT NULL
            AND timestamp IS NOT NULL AND temperature IS NOT NULL AND humidity IS NOT NULL
            AND soil_moisture IS NOT NULL AND rainfall IS NOT NULL AND battery IS NOT NULL"""),
    "null_quarantine": (("cleaned",), """
        SELECT *, 'NULL_OR_MISSING_REQUIRED_FIELD' AS invalid_reason, 'QUARANTINED' AS quarantine_status
        FROM cleaned
        WHERE reading_id IS NULL OR sensor_id IS NULL OR farm_id IS NULL OR field_id IS NULL
            OR timestamp IS NULL OR temperature IS NULL OR humidity IS NULL
            OR soil_moisture IS NULL OR rainfall IS NULL OR battery IS NULL"""),
    "dq_summary": (("checked",), """
        SELECT count(*) FILTER (is_valid) AS valid_records, count(*) FILTER (NOT is_valid) AS invalid_records,
            count(*) AS total_records
        FROM checked"""),
    "null_profile": (("cleaned",), "SELECT " + ", ".join(
        f"count(*) - count({c}) AS {c}" for c in _READING.split(", ")) + " FROM cleaned"),
    "fill_by_type": (("cleaned",), """
        SELECT reading_id, coalesce(sensor_id, 'UNKNOWN') AS sensor_id, coalesce(farm_id, 'UNKNOWN') AS farm_id,
            CASE WHEN rainfall > 0 THEN field_id ELSE 'UNKNOWN' END AS field_id,
            coalesce(timestamp, TIMESTAMP '1970-01-01 00:00:00') AS timestamp,
            coalesce(temperature, 0) AS temperature, coalesce(humidity, 0) AS humidity,
            coalesce(soil_moisture, 0) AS soil_moisture, coalesce(rainfall, 0) AS rainfall,
            coalesce(battery, 0) AS battery
        FROM cleaned"""),
    "fill_subset": (("cleaned",), """
        SELECT reading_id, coalesce(temperature, 0) AS temperature, humidity, soil_moisture,
            coalesce(rainfall, 0) AS rainfall, battery
        FROM cleaned"""),
    "status_rules": (("trusted",), f"""
        SELECT reading_id, {_STATUSES}, {_DRY.format('soil_moisture', 'rainfall', 'YES', 'NO')} AS irrigation_call
        FROM trusted"""),
    "dedup_latest": (("resent",), """
        SELECT reading_id, sensor_id, farm_id, timestamp, temperature, ingest_seq
        FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, farm_id, timestamp
                  ORDER BY ingest_seq DESC NULLS LAST, reading_id) AS copy FROM resent)
        WHERE copy = 1"""),
    "dedup_keys": (("resent",), "SELECT DISTINCT sensor_id, farm_id, timestamp FROM resent"),
    "farm_enrich": (("trusted", "farms"), """
        SELECT t.reading_id, t.sensor_id, t.farm_id, 'readings' AS _source_file, f.farm_name, f.region_id,
            CASE WHEN f.farm_key IS NOT NULL THEN 'farms' END AS farm__source_file
        FROM trusted t LEFT JOIN farms f ON t.farm_id = f.farm_key"""),
    "farm_enrich_skip": (("trusted", "farms"), """
        SELECT t.reading_id, t.sensor_id, t.farm_id, 'readings' AS _source_file, f.farm_name, f.region_id
        FROM trusted t LEFT JOIN farms f ON t.farm_id = f.farm_key"""),
    "limit_n": (("trusted",), """
        SELECT reading_id, sensor_id, farm_id, timestamp FROM trusted ORDER BY timestamp, reading_id LIMIT 20"""),
    "lag_delta_sensor": (("sensor_trend",), """
        SELECT reading_id, sensor_id, farm_id, temperature, previous_temperature,
            temperature - previous_temperature AS temperature_change
        FROM sensor_trend"""),
    "lag_delta_farm_sensor": (("pair_trend",), """
        SELECT reading_id, sensor_id, farm_id, temperature, previous_temperature, temperature_change
        FROM pair_trend"""),
    "rolling_avg_3": (("sensor_trend",), """
        SELECT reading_id, sensor_id, farm_id, temperature_rolling_avg AS three_reading_average FROM sensor_trend"""),
    "rolling_avg_3_farm_sensor": (("pair_trend",), """
        SELECT reading_id, sensor_id, farm_id, three_reading_average FROM pair_trend"""),
    "rolling_features": (("sensor_trend",), """
        SELECT reading_id, sensor_id, farm_id, temperature - previous_temperature AS temperature_change,
            soil_moisture - previous_soil_moisture AS soil_moisture_change, temperature_rolling_avg,
            humidity_rolling_avg, soil_moisture_rolling_avg, rainfall_rolling_avg
        FROM sensor_trend"""),
    "daily_stats_sensor": (("trusted",), _DAILY_STATS.format(key="sensor_id", **_OVER)),
    "daily_stats_farm": (("trusted",), _DAILY_STATS.format(
        key="farm_id", **{f: _round(over) for f, over in _OVER.items()})),
    "moisture_lags": (("moisture",), """
        SELECT reading_id, farm_id, soil_moisture, soil_moisture_lag_1, soil_moisture_lag_2, soil_moisture_lag_3
        FROM moisture"""),
    "lagged_rolling_avg": (("moisture",), """
        SELECT reading_id, farm_id, soil_moisture_rolling_avg_3, temperature_rolling_avg_3, humidity_rolling_avg_3
        FROM moisture"""),
    "next_moisture_target": (("moisture",), """
        SELECT reading_id, farm_id, reading_hour, soil_moisture, next_hour_soil_moisture FROM moisture"""),
    "farm_daily_metrics": (("trusted",), _FARM_DAILY),
    "sensor_health": (("trusted",), _SENSOR_HEALTH),
    "crop_conditions": (("trusted",), _CROPS),
    "irrigation_alerts": (("trusted",), _ALERTS),
    "environment_trend": (("pair_trend",), _TREND),
    "enriched_readings": (("sensor_trend", "farms"), f"""
        SELECT {', '.join('t.' + c for c in _READING.split(', '))}, t.reading_date,
            CAST(date_trunc('hour', t.timestamp) AS TIMESTAMP) AS reading_hour, {_STATUSES},
            previous_temperature, temperature - previous_temperature AS temperature_change,
            temperature_rolling_avg AS three_reading_average, avg(temperature) OVER w AS daily_average,
            min(temperature) OVER w AS daily_min, max(temperature) OVER w AS daily_max,
            f.farm_name, f.region_id
        FROM sensor_trend t LEFT JOIN farms f ON t.farm_id = f.farm_key
        WINDOW w AS (PARTITION BY t.sensor_id, t.reading_date)"""),
    "interaction_features": (("interacted",), """
        SELECT reading_id, temperature_humidity_interaction, soil_rainfall_interaction,
            temperature_humidity_difference, soil_moisture_deficit
        FROM interacted"""),
    "irrigation_label": (("interacted",), "SELECT reading_id, irrigation_label FROM interacted"),
    "label_distribution": (("interacted",), """
        SELECT irrigation_label, count(*) AS count FROM interacted GROUP BY irrigation_label ORDER BY 1"""),
    "irrigation_features": (("featured",), "SELECT * FROM featured"),
    "next_moisture_features": (("moisture",), "SELECT * FROM moisture"),
    "irrigation_features_cut": (("featured",), "SELECT * FROM featured"),
    "next_moisture_features_cut": (("moisture",), "SELECT * FROM moisture"),
    "next_moisture_dataset": (("dataset",), "SELECT * FROM dataset"),
    "global_ordinal": (("trusted",), """
        SELECT reading_id, farm_id, timestamp, row_number() OVER (ORDER BY timestamp, reading_id) AS ordinal
        FROM trusted"""),
    "random_split": (("hash_split",), "SELECT * FROM hash_split"),
    "chrono_split": (("split_dataset",), """
        SELECT reading_id, farm_id, timestamp, split FROM split_dataset"""),
    "irrigation_vectors": (("featured",), f"SELECT reading_id, {_vector(_IRRIGATION_VECTOR)} FROM featured"),
    "moisture_vectors": (("moisture",), f"""
        SELECT reading_id, {_vector(_MOISTURE_VECTOR)} FROM moisture
        WHERE {' AND '.join(f'{name} IS NOT NULL' for name in _MOISTURE_VECTOR)}"""),
    "irrigation_classifier": (("hash_split",), """
        SELECT split, count(*) AS records, CAST(100 AS INTEGER) AS tree_count, CAST(19 AS INTEGER) AS feature_count
        FROM hash_split GROUP BY split"""),
    "moisture_regressor": (("split_dataset",), """
        SELECT split, count(*) AS records, CAST(100 AS INTEGER) AS tree_count, CAST(13 AS INTEGER) AS feature_count
        FROM split_dataset GROUP BY split"""),
    "next_hour_target": (("trusted",), """
        SELECT farm_id, reading_hour, soil_moisture, lag(soil_moisture) OVER w AS soil_moisture_lag_1,
            lead(soil_moisture) OVER w AS next_hour_soil_moisture
        FROM (SELECT farm_id, CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS reading_hour,
                  avg(soil_moisture) AS soil_moisture
              FROM trusted GROUP BY ALL)
        WINDOW w AS (PARTITION BY farm_id ORDER BY reading_hour)"""),
    "classifier_metrics_of_rule": (("featured",), """
        SELECT round((hit1 + hit0) / n, 9) AS accuracy,
            round((is1 * hit1 / said1 + is0 * hit0 / said0) / n, 9) AS weighted_precision,
            round((hit1 + hit0) / n, 9) AS weighted_recall,
            round((is1 * 2 * hit1 / (is1 + said1) + is0 * 2 * hit0 / (is0 + said0)) / n, 9) AS f1
        FROM (SELECT CAST(count(*) AS DOUBLE) AS n,
                  CAST(count(*) FILTER (irrigation_label = 1) AS DOUBLE) AS is1,
                  CAST(count(*) FILTER (irrigation_label = 0) AS DOUBLE) AS is0,
                  CAST(count(*) FILTER (soil_moisture < 30) AS DOUBLE) AS said1,
                  CAST(count(*) FILTER (soil_moisture >= 30) AS DOUBLE) AS said0,
                  CAST(count(*) FILTER (irrigation_label = 1 AND soil_moisture < 30) AS DOUBLE) AS hit1,
                  CAST(count(*) FILTER (irrigation_label = 0 AND soil_moisture >= 30) AS DOUBLE) AS hit0
              FROM featured)"""),
    "regressor_metrics_of_mean": (("dataset",), """
        SELECT round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
            round(1 - avg(e * e) / var_pop(y), 6) AS r2
        FROM (SELECT next_hour_soil_moisture AS y,
                  next_hour_soil_moisture - soil_moisture_rolling_avg_3 AS e FROM dataset)"""),
    "moisture_predictions_of_mean": (("dataset",), f"""
        SELECT farm_id, reading_hour, temperature, humidity, soil_moisture, rainfall, battery,
            next_hour_soil_moisture, {_round('soil_moisture_rolling_avg_3')} AS predicted_next_hour_soil_moisture,
            CASE WHEN soil_moisture_rolling_avg_3 < 30 THEN 'YES' ELSE 'NO' END AS predicted_irrigation_required
        FROM dataset"""),
    "model_roundtrip": (("hash_split",), """
        SELECT count(*) AS records, CAST(0 AS BIGINT) AS differing FROM hash_split WHERE split = 'test'"""),
}


def _with(needed: tuple[str, ...]) -> list[str]:
    """The expressions a query needs, each after those it builds on."""
    ordered: list[str] = []
    for name in needed:
        for step in (*_with(_CTE[name][0]), name):
            if step not in ordered:
                ordered.append(step)
    return ordered


def sql() -> dict[str, str]:
    statements = {}
    for key, (needed, body) in _QUERIES.items():
        steps = ",\n".join(f"{name} AS ({_CTE[name][1]})" for name in _with(needed))
        statements[key] = f"WITH {steps}\n{body}" if steps else body
    return statements
