"""DuckDB SQL for every registered query.

Cells are found by an as-of join against a table of cell edges, and spelled by
interleaving bits one by one: neither shares arithmetic with the Spark code.
"""

# Fixed value: the geohash alphabet.
_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _datetime(month: str, second: str) -> str:
    def two(value: str) -> str:
        return f"lpad(cast({value} as varchar), 2, '0')"

    return (
        f"concat('{month}-0', cast(1 + ({second}) // 86400 as varchar), ' ', "
        f"{two(f'(({second}) % 86400) // 3600')}, ':', "
        f"{two(f'(({second}) % 3600) // 60')}, ':', {two(f'({second}) % 60')})"
    )


def _coordinate(whole: str, micro_degrees: str) -> str:
    return f"concat('{whole}.', lpad(cast({micro_degrees} as varchar), 6, '0'))"


def _sightings(prefix: str, types: str) -> str:
    return f"""
    select cast(event_id as varchar) as {prefix}_id,
      case when event_id % 97 = 0 then null when event_id % 101 = 0 then 'abc'
        else {_coordinate("1", "250000 + (user_id * 37 % 5) * 9000")} end as {prefix}_latitude,
      {_coordinate("103", "600000 + (user_id * 53 % 4) * 17000")} as {prefix}_longitude,
      {_datetime("2024-01", "event_id * 7919 % 172800")} as {prefix}_datetime,
      event_id
    from events where event_type in ({types})"""


_DEMAND = _sightings("cust", "'view', 'click'")
_SUPPLY = _sightings("cab", "'purchase', 'signup'")

_START = "(l_orderkey * 7919 + l_linenumber * 613 + 300) % 259200 + 300"
_END = f"{_START} + (l_partkey * 31 + l_suppkey * 17) % 3600 - 120"

_TRIPS = f"""
    select cast(l_suppkey as varchar) as trip_id,
      {_datetime("2015-09", _START)} as pickup_datetime,
      case when l_orderkey % 79 = 0 then 'oops'
        else {_datetime("2015-09", _END)} end as dropoff_datetime,
      {_coordinate("-73", "900000 + (l_suppkey * 53 % 8) * 11000")} as pickup_longitude,
      {_coordinate("40", "650000 + (l_partkey * 37 % 8) * 7000")} as pickup_latitude,
      {_coordinate("-73", "900000 + (l_partkey * 41 % 8) * 11000")} as dropoff_longitude,
      case when l_orderkey % 73 = 0 then 'abc'
        else {_coordinate("40", "650000 + (l_suppkey * 29 % 8) * 7000")} end as dropoff_latitude,
      case when l_orderkey % 89 = 0 then null when l_orderkey % 83 = 0 then 'n/a'
        else cast(cast(l_quantity as integer) as varchar) end as trip_distance,
      l_orderkey, l_linenumber, l_partkey, l_suppkey
    from lineitem"""

_TRIP_COLUMNS = (
    "trip_id, pickup_datetime, dropoff_datetime, pickup_longitude, pickup_latitude, "
    "dropoff_longitude, dropoff_latitude, trip_distance"
)


def _cells(source: str, latitude: str, longitude: str, name: str) -> str:
    """`source` with the geohash of a coordinate pair as column `name`."""
    bits = " | ".join(
        f"(((lon_index >> {b}) & 1) << {2 * b + 1}) | (((lat_index >> {b}) & 1) << {2 * b})"
        for b in range(15)
    )
    characters = " || ".join(
        f"substr('{_ALPHABET}', cast(((code >> {25 - 5 * i}) & 31) + 1 as bigint), 1)"
        for i in range(6)
    )
    return f"""
    select * exclude (lat_value, lon_value, lat_index, lon_index, code),
      case when lat_value is not null and lon_value is not null then {characters} end as {name}
    from (select *, {bits} as code from (
      select s.*, coalesce(lat.i, 0) as lat_index, coalesce(lon.i, 0) as lon_index
      from (select *, try_cast({latitude} as double) as lat_value,
              try_cast({longitude} as double) as lon_value from ({source})) s
      asof left join (select i, -90 + i * (45.0::double / 8192) as edge
                      from range(32768) r(i)) lat on s.lat_value > lat.edge
      asof left join (select i, -180 + i * (45.0::double / 4096) as edge
                      from range(32768) r(i)) lon on s.lon_value > lon.edge))"""


def _labels(datetime: str) -> str:
    def field(position: int) -> str:
        time = f"split_part({datetime}, ' ', 2)"
        return f"try_cast(split_part({time}, ':', {position}) as integer)"

    hour, minute = field(1), f"({field(2)} // 10 * 10)"
    return f"""try_cast(substr({datetime}, 1, 10) as date) as date,
      cast({hour} as varchar) || '-' || cast({hour} + 1 as varchar) as hour_interval,
      cast({minute} as varchar) || '-' || cast({minute} + 10 as varchar) as min_interval"""


_KEYS = "geohash, date, hour_interval, min_interval"


def _counts(source: str, prefix: str, name: str) -> str:
    cells = _cells(source, f"{prefix}_latitude", f"{prefix}_longitude", "geohash")
    return f"""
    select {_KEYS}, count(*) as {name}
    from (select geohash, {_labels(f"{prefix}_datetime")} from ({cells}))
    group by {_KEYS}"""


def _ratio(demand: str, supply: str, keyed: bool) -> str:
    columns = _KEYS.split(", ")
    keys = ", ".join(f"coalesce(d.{k}, s.{k}) as {k}" if keyed else f"d.{k}" for k in columns)
    match = " and ".join(f"d.{k} is not distinct from s.{k}" for k in columns)
    return f"""
    select {keys}, cust_demand_count, cab_supply_count,
      round(cust_demand_count::double / cab_supply_count, 6) as demand_supply_ratio
    from ({_counts(demand, "cust", "cust_demand_count")}) d
    full outer join ({_counts(supply, "cab", "cab_supply_count")}) s on {match}"""


def _speeds(trips: str) -> str:
    pickup = _cells(trips, "pickup_latitude", "pickup_longitude", "geohash_pickup")
    both = _cells(pickup, "dropoff_latitude", "dropoff_longitude", "geohash_dropoff")
    return f"""
    select {_TRIP_COLUMNS}, geohash_pickup, geohash_dropoff,
      cast(minutes as varchar) as trip_time,
      case when minutes <> 0
        then try_cast(trip_distance as double) * 60 / minutes end as speed
    from (select *, cast(trunc((epoch_ms(try_cast(dropoff_datetime as timestamp))
             - epoch_ms(try_cast(pickup_datetime as timestamp))) / 60000.0) as bigint) as minutes
          from ({both}))
    where geohash_pickup is not null and geohash_dropoff is not null
      and minutes is not null and trip_distance is not null"""


def _endpoints(trips: str) -> str:
    return f"""
    select geohash, {_labels("datetime")}, datetime, speed from (
      with speeds as materialized ({_speeds(trips)})
      select geohash_pickup as geohash, pickup_datetime as datetime, speed from speeds
      union all
      select geohash_dropoff, dropoff_datetime, speed from speeds)"""


def _cell_avg(trips: str, tail: str = "") -> str:
    return f"""
    with overall as (select avg(speed) as mean from ({_speeds(trips)})),
    slots as (select {_KEYS}, avg(speed) as slot_mean from ({_endpoints(trips)}) group by {_KEYS})
    select {_KEYS}, round(mean, 6) as average_speed,
      round(slot_mean, 6) as geohash_avg_speed{tail}
    from slots, overall"""


def _congestion(trips: str) -> str:
    return _cell_avg(
        trips,
        """,
      case when slot_mean > mean + 5 then 'Green' when slot_mean < mean - 1 then 'Red'
        else 'Yellow' end as congestion_status""",
    )


def _json(fields: dict[str, str]) -> str:
    """A flat JSON object of text columns. Null fields are left out."""
    members = " || ".join(
        f"""coalesce('"{field}":"' || {column} || '",', '')""" for field, column in fields.items()
    )
    return f"'{{' || rtrim({members}, ',') || '}}'"


_TRIP_PAYLOAD = _json(
    {
        "VendorID": "trip_id",
        "lpep_pickup_datetime": "pickup_datetime",
        "Lpep_dropoff_datetime": "dropoff_datetime",
        "Pickup_longitude": "pickup_longitude",
        "Pickup_latitude": "pickup_latitude",
        "Dropoff_longitude": "dropoff_longitude",
        "Dropoff_latitude": "dropoff_latitude",
        "Trip_distance": "trip_distance",
    }
)


def _sighting_payload(prefix: str) -> str:
    names = [f"{prefix}_{part}" for part in ("id", "latitude", "longitude", "datetime")]
    return _json({name: name for name in names})


def _history(trips: str = "true", drivers: str = "true", events: str = "true") -> str:
    """History rows of all topics, with a condition on each."""
    return f"""
    select {_TRIP_PAYLOAD} as payload, cast(l_orderkey * 10 + l_linenumber as varchar) as "offset",
      'trip_history' as history from ({_TRIPS}) where {trips}
    union all
    select {_sighting_payload("cust")}, cast(event_id as varchar), 'customer_history'
    from ({_DEMAND}) where {events}
    union all
    select {_sighting_payload("cab")}, cast(event_id as varchar), 'driver_history'
    from ({_SUPPLY}) where {drivers}
    union all
    select props, cast(event_id as varchar), 'error_history'
    from events where event_type = 'error' and {events}"""


# The last wave of each topic; driver messages stop one wave early.
_LAST_TRIPS = "l_orderkey % 3 = 2"
_LAST_EVENTS = "event_id % 3 = 2"
_LAST_DRIVERS = "event_id % 3 >= 1"

_SNAPSHOT_TRIPS = f"select {_TRIP_COLUMNS} from ({_TRIPS}) where {_LAST_TRIPS}"
_SNAPSHOT_DEMAND = f"select * exclude (event_id) from ({_DEMAND}) where {_LAST_EVENTS}"
_SNAPSHOT_SUPPLY = f"select * exclude (event_id) from ({_SUPPLY}) where {_LAST_DRIVERS}"

_LAST_LOADS = _history(_LAST_TRIPS, _LAST_DRIVERS, _LAST_EVENTS)

def _pick(spellings: list[str], second: str) -> str:
    cases = " ".join(f"when {i} then '{text}'" for i, text in enumerate(spellings))
    return f"concat(case l_orderkey % 4 {cases} end, cast({second} as varchar))"


_LENIENT_TRIPS = f"""
    select * replace (
      {_pick(["2015-9-1 0:0:", "2015-10--29 0:0:", "12015-9-1 0:0:", "2015-09-02 -24:00:"], _START)}
        as pickup_datetime,
      case when l_orderkey % 79 = 0 then 'oops' else
        {_pick(["2016--3-1 0:0:", "2015-8-32 0:0:", "12015-8-00032 0:0:", "2015-9-1 1:-60:"], _END)}
        end as dropoff_datetime)
    from ({_TRIPS})"""


def _lenient_speeds() -> str:
    """Minutes from the whole numbers, not from the texts."""
    pickup = _cells(_LENIENT_TRIPS, "pickup_latitude", "pickup_longitude", "geohash_pickup")
    both = _cells(pickup, "dropoff_latitude", "dropoff_longitude", "geohash_dropoff")
    return f"""
    select {_TRIP_COLUMNS}, geohash_pickup, geohash_dropoff,
      cast(minutes as varchar) as trip_time,
      case when minutes <> 0
        then round(try_cast(trip_distance as double) * 60 / minutes, 6) end as speed
    from (select *, cast(trunc((({_END}) - ({_START})) / 60.0) as bigint) as minutes
          from ({both}))
    where geohash_pickup is not null and geohash_dropoff is not null
      and l_orderkey % 79 <> 0 and trip_distance is not null"""


def _odd_counts() -> str:
    second = "(event_id * 7919 % 172800)"
    day, hour = f"({second} // 86400)", f"({second} % 86400 // 3600)"
    minute = f"({second} // 60 % 60 // 10 * 10)"
    timed = "event_id % 4 in (0, 2)"
    cells = _cells(_DEMAND, "cust_latitude", "cust_longitude", "geohash")
    return f"""
    select {_KEYS}, count(*) as cust_demand_count
    from (select geohash,
        case when event_id % 4 <> 3 then date '2024-01-01' + cast({day} as integer) end as date,
        case when {timed} then {hour} || '-' || ({hour} + 1) end as hour_interval,
        case when {timed} then {minute} || '-' || ({minute} + 10) end as min_interval
      from ({cells}))
    group by {_KEYS}"""


def _run_counts() -> str:
    counted = {
        ("ratio", "demand"): _DEMAND,
        ("ratio", "supply"): _SUPPLY,
        ("ratio", "rows"): _ratio(_DEMAND, _SUPPLY, keyed=False),
        ("congestion", "trips"): _TRIPS,
        ("congestion", "rows"): _congestion(_TRIPS),
    }
    return " union all ".join(
        f"select '{run}' as run, '{name}' as counted, count(*) as n from ({source})"
        for (run, name), source in counted.items()
    )


def _new_files() -> str:
    """The product of the events with odd numbers, and the demand that each run took."""
    odd = "where event_id % 2 = 1"
    taken = [f"select count(*) from ({_DEMAND}) where event_id % 2 = {i}" for i in (0, 1)]
    demand, supply = f"select * from ({_DEMAND}) {odd}", f"select * from ({_SUPPLY}) {odd}"
    return f"""
    select *, ({taken[0]}) as first_run, ({taken[1]}) as second_run, 0::bigint as third_run
    from ({_ratio(demand, supply, keyed=False)})"""


# Batches are the waves; a topic without rows in one has no count.
_STREAM_COUNTS = f"""
    select batch, topic, count(*) as n from (
      select l_orderkey % 3 as batch, 'congestionEstimator' as topic from lineitem
      union all select event_id % 3, 'customerData' from ({_DEMAND})
      union all select least(event_id % 3, 1), 'driverData' from ({_SUPPLY})
      union all select event_id % 3, 'appErrors' from events where event_type = 'error')
    group by batch, topic"""

ORACLES: dict[str, str] = {
    "traffic_congestion": _congestion(_TRIPS),
    "cell_avg_speed": _cell_avg(_TRIPS),
    "global_avg_speed": f"select round(avg(speed), 6) as average_speed from ({_speeds(_TRIPS)})",
    "trip_speeds": f"select * replace (round(speed, 6) as speed) from ({_speeds(_TRIPS)})",
    "trip_endpoints": f"select * replace (round(speed, 6) as speed) from ({_endpoints(_TRIPS)})",
    "trip_speeds_lenient": _lenient_speeds(),
    "odd_text_slots": _odd_counts(),
    "cell_demand_counts": _counts(_DEMAND, "cust", "cust_demand_count"),
    "cell_supply_counts": _counts(_SUPPLY, "cab", "cab_supply_count"),
    "demand_supply_ratio": _ratio(_DEMAND, _SUPPLY, keyed=False),
    "demand_supply_ratio_keyed": _ratio(_DEMAND, _SUPPLY, keyed=True),
    "history_rows": f"select *, timestamp '2024-01-03 00:00:00' as loadtime from ({_history()})",
    "latest_snapshot": f"""
    select *, timestamp '2024-01-03 00:00:00'
      + interval 1 day * (case history when 'driver_history' then 1 else 2 end) as loadtime
    from ({_LAST_LOADS})""",
    "payload_trips": f"select {_TRIP_COLUMNS} from ({_TRIPS})",
    "payload_customers": f"select * exclude (event_id) from ({_DEMAND})",
    "payload_drivers": f"select * exclude (event_id) from ({_SUPPLY})",
    "csv_landing_congestion": _congestion(_TRIPS),
    "csv_landing_ratio": _ratio(_DEMAND, _SUPPLY, keyed=False),
    "csv_landing_mixed": _ratio(_DEMAND, _SUPPLY, keyed=False),
    "csv_single_file": f"select *, 1 as files from ({_ratio(_DEMAND, _SUPPLY, keyed=False)})",
    "table_congestion": f"""
    with product as materialized ({_congestion(_TRIPS)})
    select * from product union all select * from product""",
    "table_congestion_retried": f"""
    with product as materialized ({_congestion(_TRIPS)})
    select *, unnest(['first', 'second']) as run_key from product""",
    "csv_landing_new_files": _new_files(),
    "csv_versions": _ratio(_DEMAND, _SUPPLY, keyed=False),
    "run_counts": _run_counts(),
    "stream_history": _history(),
    "stream_history_compacted": _history(),
    "stream_counts": _STREAM_COUNTS,
    "stream_interval": _history(trips="false"),
    "stream_snapshot_trips": _SNAPSHOT_TRIPS,
    "stream_snapshot_customers": _SNAPSHOT_DEMAND,
    "stream_snapshot_drivers": _SNAPSHOT_SUPPLY,
    "stream_congestion": _congestion(_SNAPSHOT_TRIPS),
    "stream_ratio": _ratio(_SNAPSHOT_DEMAND, _SNAPSHOT_SUPPLY, keyed=False),
}
