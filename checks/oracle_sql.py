"""The same results in plain SQL for DuckDB, straight from the ``events`` table.

Every statement is a chain of common table expressions.  Pair links are brute force, clusters a transitive
closure, fusion and Kalman recursive queries that walk seconds and rows one by one.
"""

from __future__ import annotations

from checks import series

DETECTIONS = """
s as (select event_id, user_id, event_type, row_number() over (partition by user_id order by ts, event_id) - 1 as seq from events),
p as (select *, cast(floor(user_id/3) as bigint) as target, cast(floor(seq/40) as bigint) as flight, seq%40 as pos from s),
l as (select *, cast(floor(pos*9/10)+7*floor(pos/10) as int) as lasting_time, 1733468325+flight*120+(target%5) as base from p),
d as (select *, (base+28800)%86400 as sod from l),
h as (select *, '92025ㆍ20241206'||lpad(cast(cast(floor(sod/3600) as int) as varchar),2,'0')
   ||lpad(cast(cast(floor(sod/60) as int)%60 as varchar),2,'0')||lpad(cast(sod%60 as varchar),2,'0')||'781' as st from d),
det as (select event_id as "offset", 'UAV'||lpad(cast(user_id as varchar),6,'0') as drone_uuid,
 st||'1' as batch_num, st as intrusion_start_time, lasting_time, base+lasting_time as "timestamp",
 cast(100+(target%4)*10+(event_id%2)*0.1 as double) as height,
 cast(22520713+(target%50)*1500+lasting_time*(50+(target%7)*5)+(event_id%3)
   +(case when event_type='error' then 40 else 0 end) as double)/1000000 as latitude,
 cast(114052045+(target%50)*1700+lasting_time*30+(event_id%3) as double)/1000000 as longitude,
 event_type, sod, target, event_id%20 as kind, 'M'||cast(target as varchar) as model
 from h)"""

# The messages that reach the fused layer: kinds 0-3 are old or bad, 4-6 are quarantined.
MESSAGE_DETECTIONS = DETECTIONS.replace("from h)", "from h where event_id%20 >= 7)")

ELEMENTS = """
el as (
 select *, case when kind=5 then '92025ㆍ2024' else batch_num end as bn, case when kind=6 then 0e0 else height end as he,
   latitude as la, longitude as lo, model as mo, 1 as ty from det where kind>=4
 union all select *, batch_num, height, latitude, longitude, 'first', 1 from det where kind=7
 union all select *, batch_num, height, latitude-0.001e0, longitude-0.001e0, model, 0 from det where kind>=5),
ods as (select bn as batch_num, 1 as detect_type, drone_uuid, 5.8e0 as frequency, he as height, intrusion_start_time, lasting_time,
 la as latitude, lo as longitude, mo as model, '[{"id":"92025"},{"id":"7"}]' as scanid, 7.5e0 as speed, ty as type,
 '100094' as station_id, "offset",
 case when kind=5 and ty=1 then 1704038400000 else (1733414400+sod)*1000+781+lasting_time end as "timestamp" from el),
odsp as (select *, strftime(make_timestamp(("timestamp"//1000+28800)*1000000),'%Y-%m-%d') as dt,
 strftime(make_timestamp(("timestamp"//1000+28800)*1000000),'%H') as hr from ods)"""

UTM = f"""
g1 as (select *, {series.forward_angles('latitude', 'longitude')} from det),
g2 as (select *, atan2(t_, cl_) as xi_, asinh(sl_/sqrt(t_*t_+cl_*cl_)) as eta_ from g1),
utm as (select * exclude (t_, sl_, cl_, xi_, eta_), {series.forward_x()} as utm_x, {series.forward_y()} as utm_y from g2)"""

_REAL = """
o as (select *, row_number() over (partition by drone_uuid,batch_num,"timestamp" order by "offset") as rk,
  drone_uuid||'_'||batch_num as signal_id from utm),
step as (select *, lag(utm_x) over w as px, lag(utm_y) over w as py, lag("timestamp") over w as pt,
  first_value(latitude) over w as start_latitude, first_value(longitude) over w as start_longitude,
  first_value(height) over w as start_height from o
  window w as (partition by signal_id order by "timestamp","offset")),
moved as (select *, case when pt is null then SPEED0 when "timestamp">pt
    then sqrt((utm_x-px)*(utm_x-px)+(utm_y-py)*(utm_y-py))/("timestamp"-pt) end as sp0,
  case when pt is null then 0e0 when "timestamp">pt then ((degrees(atan2(utm_y-py,utm_x-px))+360e0)%360e0) end as hd0 from step),
carried as (select *, last_value(sp0 ignore nulls) over w as real_speed, last_value(hd0 ignore nulls) over w as real_heading
  from moved window w as (partition by signal_id order by "timestamp","offset")),"""

CAUSAL = _REAL + """
kin as (select *, real_speed as speed, real_heading as heading from carried),
feat as (select distinct on (signal_id,"timestamp") signal_id, "timestamp", drone_uuid, batch_num, intrusion_start_time,
  start_latitude, start_longitude, start_height, lat_range, lon_range, time_range, avg_speed, avg_height, rk from (
  select *, max(latitude) over w-min(latitude) over w as lat_range, max(longitude) over w-min(longitude) over w as lon_range,
  cast(max("timestamp") over w-min("timestamp") over w as int) as time_range, avg(real_speed) over w as avg_speed,
  avg(height) over w as avg_height from kin
  window w as (partition by signal_id order by "timestamp" range between current row and 4 following)) order by rk)"""

LOOKAHEAD = _REAL + """
kin as (select *, last_value(real_speed) over w as speed, last_value(real_heading) over w as heading from carried
  window w as (partition by signal_id order by "timestamp" range between current row and 3 following))"""

# A signal starts anew after more than six seconds of silence.
GAPS = CAUSAL.replace("partition by signal_id", "partition by signal_id,flight").replace("from o\n", """from (
  select *, sum(cut) over (partition by signal_id order by "timestamp","offset") as flight from (
   select *, case when "timestamp"-lag("timestamp") over (partition by signal_id order by "timestamp","offset")>6 then 1 else 0 end as cut
   from o))
""")

LOOKAHEAD_FEATURES = LOOKAHEAD + """,
feat as (select distinct on (signal_id,"timestamp") signal_id, "timestamp", drone_uuid, batch_num, intrusion_start_time,
  start_latitude, start_longitude, start_height, lat_range, lon_range, time_range, avg_speed, avg_height, rk from (
  select *, max(latitude) over w-min(latitude) over w as lat_range, max(longitude) over w-min(longitude) over w as lon_range,
  cast(max("timestamp") over w-min("timestamp") over w as int) as time_range,
  (count(*) over same*speed+coalesce(sum(real_speed) over later,0e0))/count(*) over w as avg_speed, avg(height) over w as avg_height from kin
  window w as (partition by signal_id order by "timestamp" range between current row and 4 following),
   same as (partition by signal_id order by "timestamp" range between current row and current row),
   later as (partition by signal_id order by "timestamp" range between 1 following and 4 following)) order by rk)"""

EDGES = """
edge as (select * from (select a."timestamp" as "timestamp", a.signal_id as l, b.signal_id as r,
  1e0/(1e0+sqrt((a.lat_range-b.lat_range)**2+(a.lon_range-b.lon_range)**2+(a.time_range-b.time_range)**2
   +(a.avg_speed-b.avg_speed)**2+(a.avg_height-b.avg_height)**2)) as sim
  from feat a join feat b on a."timestamp"=b."timestamp" and a.time_range=b.time_range and a.signal_id<b.signal_id
   and abs(a.avg_height-b.avg_height)<0.26e0) where sim>0.8e0)"""

CLUSTERS = EDGES + """,
both_ways as (select "timestamp" as t, l, r from edge union all select "timestamp", r, l from edge),
closure as (select "timestamp" as t, signal_id as a, signal_id as b from feat
  union select c.t, c.a, e.r from closure c join both_ways e on e.t=c.t and e.l=c.b),
comp as (select t, a as signal_id, min(b) as cluster from closure group by all),
members as (select f.*, c.cluster from feat f join comp c on c.t=f."timestamp" and c.signal_id=f.signal_id)"""

STARTS = CLUSTERS + """,
starts as (select "timestamp", cluster, min({'start': intrusion_start_time, 'd': drone_uuid, 'b': batch_num,
  'lon': start_longitude, 'lat': start_latitude, 'h': start_height}) as c from members group by all)"""

FUSION = CLUSTERS + """,
mk as (select *, dense_rank() over (order by "timestamp") as k from members),
walk as (
  select cast(0 as bigint) as k, signal_id as sid, cast(null as varchar) as st, cast(null as double) as lon,
    cast(null as double) as lat, cast(null as double) as h, cast(null as bigint) as seen, cast(null as varchar) as pst,
    cast(null as double) as plon, cast(null as double) as plat, cast(null as double) as ph
  from (select distinct signal_id from members)
  union all
  select k, sid, case when cl is null then st when pre is null or cur.st<pre.st then cur.st else pre.st end,
    case when cl is null then lon when pre is null or cur.st<pre.st then cur.lon else pre.lon end,
    case when cl is null then lat when pre is null or cur.st<pre.st then cur.lat else pre.lat end,
    case when cl is null then h when pre is null or cur.st<pre.st then cur.h else pre.h end,
    case when cl is null then null else k end, st, lon, lat, h
  from (select w.k+1 as k, w.sid, w.st, w.lon, w.lat, w.h, m.cluster as cl,
      min(case when w.st is not null then {'st': w.st, 'd': m.drone_uuid, 'b': m.batch_num, 'lon': w.lon, 'lat': w.lat, 'h': w.h} end)
        over (partition by m.cluster) as pre,
      min({'st': m.intrusion_start_time, 'd': m.drone_uuid, 'b': m.batch_num, 'lon': m.start_longitude,
        'lat': m.start_latitude, 'h': m.start_height}) over (partition by m.cluster) as cur
    from walk w left join mk m on m.k=w.k+1 and m.signal_id=w.sid where w.k<(select max(k) from mk))),
ident as (select m."timestamp", m.signal_id, w.st as fusion_start_time, w.lon as fusion_longitude, w.lat as fusion_latitude,
  w.h as fusion_height, md5(w.st||'_'||cast(w.lon as varchar)||'_'||cast(w.lat as varchar)||'_'||cast(w.h as varchar)) as fusion_id,
  case when w.pst is not null then md5(w.pst||'_'||cast(w.plon as varchar)||'_'||cast(w.plat as varchar)||'_'||cast(w.ph as varchar)) end as pre_fusion_id
  from mk m join walk w on w.seen=m.k and w.sid=m.signal_id),
fused as (select r.*, i.fusion_id, i.pre_fusion_id, i.fusion_start_time, i.fusion_longitude, i.fusion_latitude, i.fusion_height,
  longitude-0.001e0 as driverlongitude, latitude-0.001e0 as driverlatitude
  from kin r join ident i on i."timestamp"=r."timestamp" and i.signal_id=r.signal_id)"""

KALMAN = FUSION + f""",
obs as (select *, row_number() over (partition by fusion_id order by "timestamp","offset") as rn from fused),
kal as (
  select fusion_id as fid, rn, "offset" as off, "timestamp" as ts, utm_x as px, 0e0 as vx, utm_y as py, 0e0 as vy,
    100e0 as a, 0e0 as b, 100e0 as c from obs where rn=1
  union all
  select fid, rn, off, ts, x0+k1*(zx-x0), vx+k2*(zx-x0), y0+k1*(zy-y0), vy+k2*(zy-y0), a1-k1*a1, b1-k1*b1, c1-k2*b1
  from (select *, a1/(a1+1000e0) as k1, b1/(a1+1000e0) as k2 from (
    select fid, rn, off, ts, zx, zy, vx, vy, px+dt*vx as x0, py+dt*vy as y0, a+2e0*dt*b+dt*dt*c+100e0 as a1, b+dt*c as b1, c+100e0 as c1
    from (select k.fid, o.rn, o."offset" as off, o."timestamp" as ts, o.utm_x as zx, o.utm_y as zy, k.px, k.vx, k.py, k.vy, k.a, k.b, k.c,
      case when o."timestamp"-k.ts<=0 then 1e0 else cast(o."timestamp"-k.ts as double) end as dt
      from kal k join obs o on o.fusion_id=k.fid and o.rn=k.rn+1)))),
i1 as (select fid, off, px, py, {series.inverse_angles('px', 'py')} from kal),
i2 as (select *, {series.inverse_series()} from i1),
i3 as (select *, {series.inverse_target()} from i2),
{series.newton('i3', 'i4')},
{series.newton('i4', 'i5')},
filtered as (select fid as fusion_id, off as "offset", px as fused_x, py as fused_y,
  {series.inverse_longitude()} as fused_longitude, degrees(atan(t_)) as fused_latitude from i5)"""


def _chain(*parts: str, select: str, base: str = DETECTIONS, speed: str = "0e0") -> str:
    return "with recursive " + ",".join((base, *parts)).replace("SPEED0", speed) + "\n" + select


_ODS_ALL = """batch_num, detect_type, drone_uuid, frequency, height, intrusion_start_time, lasting_time, latitude, longitude,
 model, scanid, speed, type, station_id, "timestamp", dt, hr"""
_AOA = """select '60104' as "devId", batch_num as batchno, cast("offset"%1000 as double)/4 as distance,
 cast(lasting_time as bigint) as lasting_time, 2.4e0 as channel, 'AOA' as model, cast("offset"%360 as double)/2 as direction,
 case when event_type='signup' then 1700000000000 else "timestamp"*1000 end as "timestamp"
 from det where event_type not in ('click','error')"""
_TRACK = """"offset", fusion_id, "timestamp", round(utm_x,3) as utm_x, round(utm_y,3) as utm_y, latitude, longitude,
 round(speed,3) as speed, height, round(heading,2) as heading, model, drone_uuid, 1 as status, batch_num as batchno,
 '2024-12-06 '||substr(batch_num,15,2)||':'||substr(batch_num,17,2)||':'||substr(batch_num,19,2) as takeofftime,
 start_longitude as takeofflongitude, start_latitude as takeofflatitude, round(driverlongitude,9) as driverlongitude,
 round(driverlatitude,9) as driverlatitude, 29570 as companyid, '100094' as station_id, '92025/7' as driverid"""
_LABEL = """cast("timestamp"*1000 as varchar)||'-'||cast(("timestamp"+1)*1000 as varchar)"""
_KIN = """select "offset", signal_id, "timestamp", round(utm_x,3) as utm_x, round(utm_y,3) as utm_y, round(speed,3) as speed,
 round(heading,2) as heading, start_latitude, start_longitude, start_height from kin"""
_WINDOWS = """select k."offset" as "offset", k."timestamp" as "timestamp", round(k.speed,3) as speed, round(k.heading,2) as heading,
 k.start_latitude as start_latitude, cast(k.rk as int) as curr_batch_first, f.time_range as time_range, round(f.avg_speed,3) as avg_speed,
 round(f.avg_height,6) as avg_height from kin k join feat f on f.signal_id=k.signal_id and f."timestamp"=k."timestamp" """
_FUSED_OUT = """f."offset" as "offset", f.signal_id as signal_id, f."timestamp" as "timestamp", fusion_id, fusion_start_time,
 fusion_longitude, fusion_latitude, fusion_height, pre_fusion_id"""
_PIPE = {"base": MESSAGE_DETECTIONS, "speed": "7.5e0"}


def statements() -> dict[str, str]:
    named = {
        "jm_decode_route": _chain(
            select="""select "offset", case when kind<4 then 'old' else 'new' end as route from det"""
        ),
        "jm_explode_typed": _chain(
            ELEMENTS,
            select="""select "offset", batch_num, detect_type, drone_uuid, frequency, height, intrusion_start_time, lasting_time,
 latitude, longitude, model, scanid, speed, type, station_id from ods""",
        ),
        "jm_split_counts": _chain(
            ELEMENTS,
            select="""select case when type=1 then 'drone' else 'remote' end as target, count(*) as "rows" from ods group by all""",
        ),
        "ods_partition_rows": _chain(ELEMENTS, select=f"select {_ODS_ALL} from odsp"),
        "jm_legacy_fallback": _chain(
            select="""select "offset", kind<>1 as fallback, kind<>1 as text_kept, case when kind=1 then batch_num end as batch_num,
 case when kind=1 then 1 else 0 end as target_type, case when kind=1 then 'uk-'||cast("offset" as varchar) end as "droneUK",
 case when kind=1 then latitude else 0e0 end as latitude, case when kind=1 then "timestamp"*1000 else 0 end as "timestamp"
 from det where kind<4"""
        ),
        "aoa_route_fill": _chain(
            select=f"""select *, strftime(make_timestamp(("timestamp"//1000+28800)*1000000),'%Y-%m-%d') as dt,
 strftime(make_timestamp(("timestamp"//1000+28800)*1000000),'%H') as hr from ({_AOA})"""
        ),
        "aoa_stream": _chain(
            select=f"""select *, strftime(make_timestamp(("timestamp"//1000+28800)*1000000),'%Y-%m-%d') as dt,
 strftime(make_timestamp(("timestamp"//1000+28800)*1000000),'%H') as hr from ({_AOA})"""
        ),
        "ods_stream": _chain(ELEMENTS, select=f"select {_ODS_ALL} from odsp"),
        "table_roundtrip": _chain(ELEMENTS, select=f"select {_ODS_ALL} from odsp where type=1 and dt>='2024-12-06'"),
        "message_balance": f"""with {DETECTIONS}, {ELEMENTS},
m as (select 'dwd messages' as job, case when kind<2 then 'not a JSON text of an object' when kind<4 then 'no drone array'
   when kind=4 then 'no pilot element' when kind=5 then 'no start time' when kind=6 then 'bad number' else 'usable' end as outcome from det
 union all select 'ods_jm messages', case when kind<4 then 'old' else 'new' end from det
 union all select 'ods_jm elements', 'usable' from el
 union all select 'ods_aoa messages', case when event_type in ('error','click') then 'old' else 'usable' end from det)
select job, outcome, count(*) as n from m group by all""",
        "pair_pilot_drone": _chain(
            select="""select "offset", case kind when 0 then 'not a JSON text of an object' when 1 then 'not a JSON text of an object'
 when 2 then 'no drone array' when 3 then 'no drone array' when 4 then 'no pilot element' when 5 then 'no start time'
 when 6 then 'bad number' end as reason,
 case when kind>=7 then drone_uuid||'_'||batch_num end as signal_id,
 case when kind>=7 then 1733414400+sod+lasting_time else 0 end as event_time,
 case when kind>=7 then longitude-0.001e0 end as driverlongitude, case when kind>=7 then latitude-0.001e0 end as driverlatitude,
 case when kind>=7 then height end as height, case when kind>=7 then model end as model from det"""
        ),
        "utm_forward": _chain(
            UTM, select="""select "offset", round(utm_x,3) as utm_x, round(utm_y,3) as utm_y from utm"""
        ),
        "utm_inverse": _chain(
            select="""select "offset", round(longitude,9) as longitude, round(latitude,9) as latitude from det"""
        ),
        "kinematics_causal": _chain(UTM, CAUSAL, select=_KIN),
        "kinematics_lookahead": _chain(UTM, LOOKAHEAD, select=_KIN),
        "start_position": _chain(
            UTM, CAUSAL,
            select="""select distinct signal_id, start_latitude, start_longitude, start_height from kin""",
        ),
        "slice_rank": _chain(
            UTM, CAUSAL,
            select=f"""select "offset", signal_id, {_LABEL} as curr_batch_time, cast(rk as int) as curr_batch_first from kin""",
        ),
        "window_features": _chain(
            UTM, CAUSAL,
            select="""select signal_id, "timestamp", round(lat_range,9) as lat_range, round(lon_range,9) as lon_range, time_range,
 round(avg_speed,3) as avg_speed, round(avg_height,6) as avg_height from feat""",
        ),
        "window_features_lookahead": _chain(
            UTM, LOOKAHEAD_FEATURES,
            select="""select signal_id, "timestamp", round(lat_range,9) as lat_range, round(lon_range,9) as lon_range, time_range,
 round(avg_speed,3) as avg_speed, round(avg_height,6) as avg_height from feat""",
        ),
        "window_stream_lookahead": _chain(UTM, LOOKAHEAD_FEATURES, select=_WINDOWS, **_PIPE),
        "expiry_stream": _chain(UTM, GAPS, select=_WINDOWS, **_PIPE),
        "late_rows": _chain(
            base=MESSAGE_DETECTIONS,
            select="""select "offset", "timestamp", "timestamp"-4 as window_from, "timestamp" as window_to,
 drone_uuid||'_'||batch_num as signal_id from det where "offset"%100=59""",
        ),
        "kinematics_gaps": _chain(UTM, GAPS, select=_KIN),
        "sliding_window_counts": _chain(
            select="""select drone_uuid, batch_num, "timestamp"-b as window_start, count(*) as "rows"
 from det, (select unnest(range(5)) as b) group by all"""
        ),
        "similarity_edges": _chain(
            UTM, CAUSAL, EDGES,
            select="""select "timestamp", l as left_signal, r as right_signal, round(sim,4) as similarity from edge""",
        ),
        "signal_components": _chain(
            UTM, CAUSAL, CLUSTERS, select="""select "timestamp", signal_id, cluster from members"""
        ),
        "cluster_quality": _chain(
            UTM, CAUSAL, CLUSTERS,
            select="""select "timestamp", count(*) as clusters, round(avg(w),4) as quality from (
 select a."timestamp", a.cluster, coalesce(avg(1e0/(1e0+sqrt((a.lat_range-b.lat_range)**2+(a.lon_range-b.lon_range)**2
  +(a.time_range-b.time_range)**2+(a.avg_speed-b.avg_speed)**2+(a.avg_height-b.avg_height)**2))) filter (where a.signal_id<b.signal_id), 0e0) as w
 from members a join members b on a."timestamp"=b."timestamp" and a.cluster=b.cluster group by all) group by all""",
        ),
        "cluster_members": _chain(
            UTM, CAUSAL, CLUSTERS,
            select="""select "timestamp", cast(dense_rank() over (partition by "timestamp" order by first_member)-1 as int) as cluster_index,
 signal_id from (select *, min({'d': drone_uuid, 'b': batch_num}) over (partition by "timestamp", cluster) as first_member from members)""",
        ),
        "cluster_start": _chain(
            UTM, CAUSAL, STARTS,
            select="""select "timestamp", cluster, c.start as start_time, c.d as drone_uuid, c.b as batch_num, c.lon as start_longitude,
 c.lat as start_latitude, c.h as start_height from starts""",
        ),
        "fusion_ids": _chain(UTM, CAUSAL, FUSION, select=f"select {_FUSED_OUT} from fused f"),
        "track_projection": _chain(UTM, CAUSAL, FUSION, select=f"select {_TRACK} from fused"),
        "kalman_track": _chain(
            UTM, CAUSAL, KALMAN,
            select="""select "offset", fusion_id, round(fused_x,3) as fused_x, round(fused_y,3) as fused_y,
 round(fused_longitude,8) as fused_longitude, round(fused_latitude,8) as fused_latitude from filtered""",
        ),
        "push_payload": _chain(
            UTM, CAUSAL, FUSION,
            select="""select "offset", fusion_id, round(utm_x,3) as utm_x, round(latitude,6) as latitude, 21 as fields from fused""",
        ),
        "dwd_pipeline": _chain(
            UTM, CAUSAL, FUSION, **_PIPE,
            select=f"""select {_FUSED_OUT}, round(f.utm_x,3) as utm_x, round(f.utm_y,3) as utm_y, round(f.speed,3) as speed,
 round(f.heading,2) as heading, cast(f.rk as int) as curr_batch_first, t.time_range as time_range, round(t.avg_speed,3) as avg_speed
 from fused f join feat t on t.signal_id=f.signal_id and t."timestamp"=f."timestamp" """,
        ),
        "dwd_pipeline_lookahead": _chain(
            UTM, LOOKAHEAD_FEATURES, FUSION, **_PIPE,
            select=f"""select {_FUSED_OUT}, round(f.utm_x,3) as utm_x, round(f.utm_y,3) as utm_y, round(f.speed,3) as speed,
 round(f.heading,2) as heading, cast(f.rk as int) as curr_batch_first, t.time_range as time_range, round(t.avg_speed,3) as avg_speed
 from fused f join feat t on t.signal_id=f.signal_id and t."timestamp"=f."timestamp" """,
        ),
        "dws_pipeline": _chain(
            UTM, CAUSAL, KALMAN, **_PIPE,
            select=f"""select f.*, round(k.fused_x,3) as fused_x, round(k.fused_y,3) as fused_y,
 round(k.fused_longitude,8) as fused_longitude, round(k.fused_latitude,8) as fused_latitude
 from (select {_TRACK} from fused) f join filtered k on k."offset"=f."offset" """,
        ),
    }
    streams = {"fan_out_stream": "ods_stream", "dwd_stream": "dwd_pipeline", "recovery_stream": "dwd_pipeline", "dws_stream": "dws_pipeline"}
    return named | {stream: named[batch] for stream, batch in streams.items()}
