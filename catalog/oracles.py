"""Independent SQL forms of the queries, for DuckDB.

Grids are filled here by counting crossed edges per candidate cell, tiles are
met by testing each edge against each candidate tile box, and so on: the same
definitions, reached another way.
"""

from __future__ import annotations


# -- fixtures --------------------------------------------------------------------

POLY = """
poly AS (
  SELECT p_partkey AS fid, p_type AS layer,
    CAST(p_partkey*37%1000 AS DOUBLE)/CAST(100 AS DOUBLE) AS x0,
    CAST(p_partkey*61%600 AS DOUBLE)/CAST(100 AS DOUBLE) AS y0,
    CAST(p_size AS DOUBLE)/CAST(100 AS DOUBLE) AS w,
    CASE WHEN p_partkey%17=0 THEN 'flat' WHEN p_partkey%19=0 THEN 'bow'
         WHEN p_partkey%4=1 THEN 'box' WHEN p_partkey%4=2 THEN 'frame' ELSE 'tri' END AS shape,
    CASE p_partkey%11 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN '0' WHEN 3 THEN 'nan'
         WHEN 4 THEN NULL WHEN 5 THEN '   ' ELSE p_brand END AS category,
    CASE p_partkey%13 WHEN 0 THEN NULL WHEN 1 THEN CAST('nan' AS DOUBLE) ELSE p_retailprice END AS price,
    CAST(p_size AS INTEGER) AS size
  FROM part),
corner(shape, ring, pos, ax, bx, ay, by_) AS (VALUES
  ('tri',0,0,0,1,0,1),('tri',0,1,1,1,1,3),('tri',0,2,1,4,1,1),('tri',0,3,0,1,0,1),
  ('box',0,0,0,1,0,1),('box',0,1,1,1,0,1),('box',0,2,1,1,1,1),('box',0,3,0,1,1,1),('box',0,4,0,1,0,1),
  ('frame',0,0,0,1,0,1),('frame',0,1,1,1,0,1),('frame',0,2,1,1,1,1),('frame',0,3,0,1,1,1),('frame',0,4,0,1,0,1),
  ('frame',1,0,1,4,1,4),('frame',1,1,3,4,1,4),('frame',1,2,3,4,3,4),('frame',1,3,1,4,3,4),('frame',1,4,1,4,1,4),
  ('flat',0,0,0,1,0,1),('flat',0,1,1,1,0,1),('flat',0,2,1,2,0,1),('flat',0,3,0,1,0,1),
  ('bow',0,0,0,1,0,1),('bow',0,1,1,1,1,1),('bow',0,2,1,1,0,1),('bow',0,3,0,1,1,2),('bow',0,4,0,1,0,1)),
vert AS (
  SELECT fid, layer, ring, pos, x0 + w*CAST(ax AS DOUBLE)/CAST(bx AS DOUBLE) AS x,
         y0 + w*CAST(ay AS DOUBLE)/CAST(by_ AS DOUBLE) AS y
  FROM poly JOIN corner USING (shape))"""

BOUNDS = """
bounds AS (
  SELECT layer, min(x) AS lon_min, min(y) AS lat_min, max(x) AS lon_max, max(y) AS lat_max
  FROM vert GROUP BY layer)"""

SPEC = """
sized AS (
  SELECT *, greatest(1, CAST(ceil((lon_max-lon_min)/CAST(0.01 AS DOUBLE)) AS BIGINT)) AS nx,
            greatest(1, CAST(ceil((lat_max-lat_min)/CAST(0.01 AS DOUBLE)) AS BIGINT)) AS ny FROM bounds),
spec AS (
  SELECT *, CASE WHEN lon_max>lon_min THEN (lon_max-lon_min)/CAST(nx AS DOUBLE) ELSE CAST(0.01 AS DOUBLE) END AS dx,
            CASE WHEN lat_max>lat_min THEN (lat_max-lat_min)/CAST(ny AS DOUBLE) ELSE CAST(0.01 AS DOUBLE) END AS dy
  FROM sized)"""

# edges in pixel space, low to high row
EDGES = """
px AS (
  SELECT v.fid, v.layer, v.ring, v.pos, (v.x-s.lon_min)/s.dx AS px, (s.lat_max-v.y)/s.dy AS py
  FROM vert v JOIN spec s USING (layer)),
seg AS (
  SELECT a.fid, a.layer, a.ring, a.pos,
    CASE WHEN a.py<=b.py THEN a.px ELSE b.px END AS ex0, least(a.py,b.py) AS ey0,
    CASE WHEN a.py<=b.py THEN b.px ELSE a.px END AS ex1, greatest(a.py,b.py) AS ey1
  FROM px a JOIN px b ON a.fid=b.fid AND a.ring=b.ring AND b.pos=a.pos+1)"""

# parity of crossed edges, counted for every cell of every feature's box
BURNS = """
box AS (
  SELECT fid, layer, CAST(floor(min(px)) AS BIGINT)-1 AS c_lo, CAST(ceil(max(px)) AS BIGINT)+1 AS c_hi,
         CAST(floor(min(py)) AS BIGINT)-1 AS r_lo, CAST(ceil(max(py)) AS BIGINT)+1 AS r_hi
  FROM px GROUP BY fid, layer),
boxrow AS (
  SELECT b.fid, b.layer, b.c_lo, b.c_hi, s.nx, unnest(range(greatest(b.r_lo,0), least(b.r_hi+1, s.ny))) AS row
  FROM box b JOIN spec s USING (layer)),
cut AS (
  SELECT r.fid, r.layer, r.row,
    e.ex0 + (CAST(r.row AS DOUBLE)+CAST(0.5 AS DOUBLE)-e.ey0)*(e.ex1-e.ex0)/(e.ey1-e.ey0) AS xc
  FROM boxrow r JOIN seg e ON e.fid=r.fid
   AND e.ey0<=CAST(r.row AS DOUBLE)+CAST(0.5 AS DOUBLE) AND CAST(r.row AS DOUBLE)+CAST(0.5 AS DOUBLE)<e.ey1),
cand AS (
  SELECT fid, layer, row, unnest(range(greatest(c_lo,0), least(c_hi+1, nx))) AS col FROM boxrow),
burns AS (
  SELECT c.layer, c.fid, c.row, c.col
  FROM cand c JOIN cut k ON k.fid=c.fid AND k.row=c.row AND k.xc<=CAST(c.col AS DOUBLE)+CAST(0.5 AS DOUBLE)
  GROUP BY c.layer, c.fid, c.row, c.col HAVING count(*)%2=1)"""

WINNERS = """
winners AS (SELECT layer, row, col, max(fid) AS fid FROM burns GROUP BY layer, row, col)"""

POINTS = """
pts AS (
  SELECT event_id AS fid, event_type AS layer, value,
    CAST((user_id*37+event_id*13)%1000 AS DOUBLE)/CAST(100 AS DOUBLE) AS x,
    CAST((user_id*61+event_id*7)%600 AS DOUBLE)/CAST(100 AS DOUBLE) AS y FROM events),
vert AS (SELECT * FROM pts)"""

POINT_BURNS = """
fell AS (
  SELECT v.layer, v.fid, v.value, CAST(floor((s.lat_max-v.y)/s.dy) AS BIGINT) AS row,
         CAST(floor((v.x-s.lon_min)/s.dx) AS BIGINT) AS col, s.nx, s.ny
  FROM vert v JOIN spec s USING (layer)),
burns AS (SELECT layer, fid, value, row, col FROM fell WHERE row BETWEEN 0 AND ny-1 AND col BETWEEN 0 AND nx-1)"""

LINES = """
ends AS (
  SELECT s_suppkey AS fid, 'lines_'||(s_suppkey%2) AS layer,
    CAST(s_suppkey*37%1000 AS DOUBLE)/CAST(100 AS DOUBLE) AS ux, CAST(s_suppkey*61%600 AS DOUBLE)/CAST(100 AS DOUBLE) AS uy,
    CAST(s_suppkey*53%1000 AS DOUBLE)/CAST(100 AS DOUBLE) AS vx, CAST(s_suppkey*29%600 AS DOUBLE)/CAST(100 AS DOUBLE) AS vy
  FROM supplier),
vert AS (SELECT layer, ux AS x, uy AS y FROM ends UNION ALL SELECT layer, vx, vy FROM ends)"""

ZONES = """
zone AS (
  SELECT s_suppkey AS zone_id, CAST(s_suppkey*37%1000 AS DOUBLE)/CAST(100 AS DOUBLE) AS cx,
    CAST(s_suppkey*61%600 AS DOUBLE)/CAST(100 AS DOUBLE) AS cy, CAST(0.1 AS DOUBLE) AS radius FROM supplier)"""

RASTER = """
ras AS (
  SELECT CAST(o_orderkey%3+1 AS BIGINT) AS band, o_orderkey//3//50 AS row, (o_orderkey//3)%50 AS col,
    CASE WHEN o_orderkey%17=0 THEN CAST('nan' AS DOUBLE) ELSE o_totalprice END AS value FROM orders),
g AS (SELECT max(row)+1 AS ny, max(col)+1 AS nx, CAST(10 AS DOUBLE)/CAST(max(col)+1 AS DOUBLE) AS dx,
             CAST(6 AS DOUBLE)/CAST(max(row)+1 AS DOUBLE) AS dy FROM ras)"""

HALF = "CAST(0.5 AS DOUBLE)"


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n" + select.strip()


def label(i: str, first: str, last: str, n: str) -> str:
    """Rounded evenly spaced label."""
    return (
        f"round_even((CASE WHEN {n}>1 AND {i}={n}-1 THEN {last} WHEN {n}=1 THEN {first} "
        f"ELSE CAST({i} AS DOUBLE)*(({last}-{first})/CAST({n}-1 AS DOUBLE))+{first} END)*CAST(10000 AS DOUBLE),0)/CAST(10000 AS DOUBLE)"
    )


def cleaned(rule: str) -> str:
    basic = "category IN ('',' ','nan')"
    return {
        "basic": f"CASE WHEN {basic} THEN 'None' ELSE category END",
        "zero": "CASE WHEN category IN ('',' ','nan','0') THEN 'None' ELSE category END",
        "strip": "CASE WHEN category='0' OR regexp_full_match(category, '\\s*') THEN 'None' ELSE category END",
    }[rule]


def filled(rule: str) -> str:
    return f"coalesce({cleaned(rule)}, 'None')"


SPELLED = "coalesce({}, '(null)')"
F32 = "CAST(CAST({} AS FLOAT) AS DOUBLE)"
NAN = "CAST('nan' AS DOUBLE)"

FIRST_CODES = f"""
firsts AS (SELECT layer, {filled('basic')} AS category, min(fid) AS first_fid FROM poly GROUP BY ALL),
codes AS (SELECT layer, category, row_number() OVER (PARTITION BY layer ORDER BY first_fid) AS code FROM firsts)"""

# an edge meets a closed box unless an axis or the edge's own normal separates them
TILE_HITS = """
tl AS (
  SELECT layer, nx, ny, tr.t AS tile_row, tc.t AS tile_col, tr.t*200 AS r0, least((tr.t+1)*200, ny) AS r1,
         tc.t*200 AS c0, least((tc.t+1)*200, nx) AS c1,
         tr.t*CAST(ceil(nx/CAST(200 AS DOUBLE)) AS BIGINT)+tc.t AS tile_seq
  FROM spec, (SELECT unnest(range(0,100)) AS t) tr, (SELECT unnest(range(0,100)) AS t) tc
  WHERE tr.t*200<ny AND tc.t*200<nx),
side AS (
  SELECT e.fid, t.layer, t.tile_row, t.tile_col, t.tile_seq,
    (ex1-ex0)*(r0-ey0)-(ey1-ey0)*(c0-ex0) AS s1, (ex1-ex0)*(r0-ey0)-(ey1-ey0)*(c1-ex0) AS s2,
    (ex1-ex0)*(r1-ey0)-(ey1-ey0)*(c0-ex0) AS s3, (ex1-ex0)*(r1-ey0)-(ey1-ey0)*(c1-ex0) AS s4
  FROM seg e JOIN tl t ON t.layer=e.layer AND least(ex0,ex1)<=c1 AND greatest(ex0,ex1)>=c0 AND ey0<=r1 AND ey1>=r0),
inside AS (
  SELECT e.fid, t.layer, t.tile_row, t.tile_col, t.tile_seq
  FROM seg e JOIN tl t ON t.layer=e.layer AND e.ey0<=r0+0.5::DOUBLE AND r0+0.5::DOUBLE<e.ey1
   AND e.ex0+(r0+0.5::DOUBLE-e.ey0)*(e.ex1-e.ex0)/(e.ey1-e.ey0)<=c0+0.5::DOUBLE
  GROUP BY ALL HAVING count(*)%2=1),
hits AS (
  SELECT fid, layer, tile_row, tile_col, tile_seq FROM side
   WHERE least(s1,s2,s3,s4)<=0 AND greatest(s1,s2,s3,s4)>=0
  UNION SELECT * FROM inside)"""

DISC = """
edge AS (
  SELECT a.fid, a.layer, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_
  FROM vert a JOIN vert b ON a.fid=b.fid AND a.ring=b.ring AND b.pos=a.pos+1),
fbox AS (SELECT fid, layer, min(x) AS fx0, max(x) AS fx1, min(y) AS fy0, max(y) AS fy1 FROM vert GROUP BY ALL),
near AS (
  SELECT z.*, f.fid, f.layer FROM zone z JOIN fbox f
    ON fx0<=cx+radius AND fx1>=cx-radius AND fy0<=cy+radius AND fy1>=cy-radius),
dist AS (
  SELECT zone_id, n.layer, n.fid, cx, cy, radius, ax, ay, bx, by_,
    least(1, greatest(0, CASE WHEN (bx-ax)*(bx-ax)+(by_-ay)*(by_-ay)=0 THEN 0
      ELSE ((cx-ax)*(bx-ax)+(cy-ay)*(by_-ay))/((bx-ax)*(bx-ax)+(by_-ay)*(by_-ay)) END)) AS t
  FROM near n JOIN edge e ON e.fid=n.fid),
touch AS (
  SELECT zone_id, layer, fid FROM dist
  GROUP BY ALL
  HAVING min((cx-(ax+t*(bx-ax)))*(cx-(ax+t*(bx-ax)))+(cy-(ay+t*(by_-ay)))*(cy-(ay+t*(by_-ay)))) <= min(radius*radius)
      OR count(*) FILTER (WHERE least(ay,by_)<=cy AND cy<greatest(ay,by_)
           AND CASE WHEN ay<=by_ THEN ax+(cy-ay)*(bx-ax)/(by_-ay) ELSE bx+(cy-by_)*(ax-bx)/(ay-by_) END <= cx)%2=1)"""

# vertices of the 64-sided zone outline, then parity against raster cell centres
ZONE_CELLS = """
zv AS (
  SELECT zone_id, i, cx+radius*cos(CAST(i%64 AS DOUBLE)*(2*pi()/64)) AS x, cy-radius*sin(CAST(i%64 AS DOUBLE)*(2*pi()/64)) AS y
  FROM zone, (SELECT unnest(range(0,65)) AS i)),
zp AS (SELECT zone_id, i, (x-0)/g.dx AS px, (6-y)/g.dy AS py FROM zv, g),
ze AS (
  SELECT a.zone_id, CASE WHEN a.py<=b.py THEN a.px ELSE b.px END AS x0, least(a.py,b.py) AS y0,
    CASE WHEN a.py<=b.py THEN b.px ELSE a.px END AS x1, greatest(a.py,b.py) AS y1
  FROM zp a JOIN zp b ON a.zone_id=b.zone_id AND b.i=a.i+1),
zb AS (
  SELECT zone_id, greatest(0,CAST(floor(min(px)) AS BIGINT)-1) AS c0, least((SELECT nx FROM g)-1,CAST(ceil(max(px)) AS BIGINT)) AS c1,
    greatest(0,CAST(floor(min(py)) AS BIGINT)-1) AS r0, least((SELECT ny FROM g)-1,CAST(ceil(max(py)) AS BIGINT)) AS r1
  FROM zp GROUP BY zone_id),
zr AS (SELECT zone_id, c0, c1, unnest(range(r0,r1+1)) AS row FROM zb),
zc AS (SELECT zone_id, row, unnest(range(c0,c1+1)) AS col FROM zr),
covered AS (
  SELECT zc.zone_id, zc.row, zc.col FROM zc JOIN ze ON ze.zone_id=zc.zone_id
   AND y0<=zc.row+0.5::DOUBLE AND zc.row+0.5::DOUBLE<y1
   AND x0+(zc.row+0.5::DOUBLE-y0)*(x1-x0)/(y1-y0)<=zc.col+0.5::DOUBLE
  GROUP BY ALL HAVING count(*)%2=1)"""

THREE = """
lab AS (
  SELECT band, value, round_even((6-(CAST(row AS DOUBLE)+0.5::DOUBLE)*g.dy)*1e4,0)/1e4 AS latitude,
    round_even(((0+(CAST(col AS DOUBLE)+0.5::DOUBLE)*g.dx)+CAST(band-1 AS DOUBLE))*1e4,0)/1e4 AS longitude
  FROM ras, g)"""

VALID = """
relv AS (
  SELECT v.fid, v.ring, v.pos, v.x, v.y, o.x AS ox, o.y AS oy
  FROM vert v JOIN vert o ON o.fid=v.fid AND o.ring=v.ring AND o.pos=0),
area AS (
  SELECT a.fid, a.ring, sum((a.x-a.ox)*(b.y-a.oy)-(b.x-a.ox)*(a.y-a.oy)) AS a2
  FROM relv a JOIN relv b ON a.fid=b.fid AND a.ring=b.ring AND b.pos=a.pos+1 GROUP BY a.fid, a.ring),
sg AS (
  SELECT a.fid, a.ring*100+a.pos AS i, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_
  FROM vert a JOIN vert b ON a.fid=b.fid AND a.ring=b.ring AND b.pos=a.pos+1),
crossed AS (
  SELECT DISTINCT e.fid FROM sg e JOIN sg f ON e.fid=f.fid AND e.i<f.i
  WHERE sign((e.bx-e.ax)*(f.ay-e.ay)-(e.by_-e.ay)*(f.ax-e.ax))*sign((e.bx-e.ax)*(f.by_-e.ay)-(e.by_-e.ay)*(f.bx-e.ax))<0
    AND sign((f.bx-f.ax)*(e.ay-f.ay)-(f.by_-f.ay)*(e.ax-f.ax))*sign((f.bx-f.ax)*(e.by_-f.ay)-(f.by_-f.ay)*(e.bx-f.ax))<0),
sound AS (
  SELECT * FROM poly WHERE fid NOT IN (SELECT fid FROM area WHERE a2=0) AND fid NOT IN (SELECT fid FROM crossed))"""

AXIS_TABLE = """
axes AS (
  SELECT layer, 'latitude' AS axis, i AS idx, {lat} AS label FROM (SELECT *, unnest(range(0,ny)) AS i FROM spec)
  UNION ALL
  SELECT layer, 'longitude', i, {lon} FROM (SELECT *, unnest(range(0,nx)) AS i FROM spec))""".format(
    lat=label("i", "lat_max", "lat_min", "ny"), lon=label("i", "lon_min", "lon_max", "nx")
)

RASTER_SPEC = """
spec AS (
  SELECT DISTINCT CAST(band AS VARCHAR) AS layer, 0::DOUBLE AS lon_min, 0::DOUBLE AS lat_min, 10::DOUBLE AS lon_max,
    6::DOUBLE AS lat_max, nx, ny, dx, dy FROM ras, g)"""

TITLE = """
titled AS (
  SELECT page_id, url, b, CASE WHEN regexp_full_match(b, '.*[^.].*\\.[^.]*')
    THEN left(b, length(b)-length(string_split(b,'.')[-1])-1) ELSE b END AS title
  FROM (SELECT page_id, url, string_split(url,'/')[-1] AS b FROM pages))"""

GRID = (POLY, BOUNDS, SPEC)
CELLS = (POLY, BOUNDS, SPEC, EDGES, BURNS, WINNERS)

ORACLES: dict[str, str] = {}


def oracle(name: str, *parts: str, select: str) -> None:
    ORACLES[name] = with_(*parts, select=select)


# -- scans, sources, sinks ---------------------------------------------------------

oracle("scan_features", POLY, select=f"""
SELECT fid, layer, 'POLYGON' AS geom_type, {SPELLED.format('category')} AS category,
  CASE WHEN price IS NULL THEN 'null' WHEN isnan(price) THEN 'nan' ELSE 'value' END AS price_state,
  CASE WHEN price IS NULL OR isnan(price) THEN CAST(-1 AS DOUBLE) ELSE price END AS price,
  CAST(size AS BIGINT) AS size, n AS n_vertices
FROM poly JOIN (SELECT shape, count(*) AS n FROM corner GROUP BY shape) USING (shape)""")
oracle("parse_wkt", POLY, select="""
SELECT fid, 'POLYGON' AS geom_type, CAST(ring AS BIGINT) AS ring, CAST(pos AS BIGINT) AS pos, x, y FROM vert""")
oracle("list_layers", POLY, select="SELECT DISTINCT layer FROM poly")
oracle("layer_schema", POLY, select="""
SELECT layer, pos, variable, kind, CASE variable WHEN 'category' THEN c WHEN 'price' THEN p ELSE s END AS present
FROM (SELECT layer, CAST(count(category)>0 AS BIGINT) AS c, CAST(count(price)>0 AS BIGINT) AS p,
             CAST(count(size)>0 AS BIGINT) AS s FROM poly GROUP BY layer),
     (VALUES (1::BIGINT,'category','categorical'),(2,'price','numeric'),(3,'size','numeric')) k(pos, variable, kind)""")
oracle("scan_pruned", POLY, select="SELECT fid, layer, CAST(size AS BIGINT) AS size FROM poly")
oracle("scan_raster", RASTER, select="SELECT band, row, col, value FROM ras")
oracle("band_info", RASTER, select="""
SELECT band, count(*) AS n_cells, any_value(r_name) AS description
FROM ras LEFT JOIN region ON r_regionkey+1=band GROUP BY band""")
oracle("scan_chunks", RASTER, select="SELECT band, row, col, value FROM ras")
oracle("write_chunks", RASTER, select=f"""
SELECT 'raster' AS layer, 'value_'||band AS var, row, col, {F32.format('value')} AS value FROM ras""")
oracle("write_array_store", RASTER, select=f"""
SELECT 'value_'||band AS var, row, col, {F32.format('value')} AS value FROM ras WHERE value<>0""")
oracle("stack_bands", RASTER, select=f"""
SELECT row+(band-1)*ny AS row, col, {F32.format('value')} AS value FROM ras, g""")
oracle("match_files", TITLE, select="SELECT page_id, b AS name FROM titled WHERE b LIKE '%.html'")

# -- projections, filters, predicates ------------------------------------------------

oracle("select_variables", POLY, select="""
SELECT layer, fid, CAST(size AS BIGINT) AS size,
  CASE WHEN price IS NULL OR isnan(price) THEN CAST(0 AS DOUBLE) ELSE price END AS price FROM poly""")
for rule in ("basic", "zero", "strip"):
    oracle(f"clean_{rule}", POLY, select=f"SELECT fid, {SPELLED.format(cleaned(rule))} AS category FROM poly")
oracle("fill_category", POLY, select=f"SELECT fid, {filled('basic')} AS category FROM poly")
oracle("cast_numeric", POLY, select=f"""
SELECT fid, coalesce({F32.format('price')}, {NAN}) AS price,
  CASE WHEN price IS NULL OR isnan(price) THEN CAST(0 AS DOUBLE) ELSE {F32.format('price')} END AS price_zero,
  CAST(size AS DOUBLE) AS size FROM poly""")
oracle("nan_to_zero", POLY, select=f"""
SELECT fid, CASE WHEN price IS NULL OR isnan(price) THEN CAST(0 AS DOUBLE) ELSE {F32.format('price')} END AS price FROM poly""")
oracle("classify_columns", POLY, select="""
SELECT layer, 'category' AS variable, 'categorical' AS kind, count(category) AS n_values FROM poly GROUP BY layer
UNION ALL SELECT layer, 'price', 'numeric', count(price) FROM poly GROUP BY layer
UNION ALL SELECT layer, 'size', 'numeric', count(size) FROM poly GROUP BY layer""")
oracle("valid_geometries", POLY, VALID, select="SELECT layer, fid FROM sound")
oracle("mask_equals", *CELLS, select="""
SELECT w.layer, w.row, w.col FROM winners w JOIN poly p USING (fid) WHERE p.size=2""")
oracle("mask_valid", RASTER, select="SELECT band, row, col FROM ras WHERE NOT isnan(value)")
oracle("rename_dims", RASTER, select=f"""
SELECT band, 6::DOUBLE-(CAST(row AS DOUBLE)+{HALF})*dy AS latitude, 0::DOUBLE+(CAST(col AS DOUBLE)+{HALF})*dx AS longitude,
  value AS depth_ratio FROM ras, g""")
oracle("select_band", RASTER, select="SELECT row, col, value FROM ras WHERE band=1")
oracle("lookup_label", RASTER, select="SELECT band, row, col, value FROM ras WHERE row=3 AND col=7")
oracle("lookup_position", RASTER, POINTS, select="""
SELECT p.fid, r.row, r.col, r.value FROM pts p, g JOIN ras r
  ON r.band=1 AND r.row=CAST(floor((6-p.y)/g.dy) AS BIGINT) AND r.col=CAST(floor((p.x-0)/g.dx) AS BIGINT)""")
_lat = label("row", "6::DOUBLE", "0::DOUBLE", "ny")
_lon = label("col", "0::DOUBLE", "10::DOUBLE", "nx")
oracle("subset_bbox", RASTER, select=f"""
SELECT * FROM (SELECT band, row, col, {_lat} AS latitude, {_lon} AS longitude FROM ras, g)
WHERE latitude>=1 AND latitude<=5 AND longitude>=2 AND longitude<=8""")
oracle("scan_chunks_box", RASTER, select=f"""
SELECT * FROM (SELECT row, col, {_lat} AS latitude, {_lon} AS longitude, value FROM ras, g WHERE band=2)
WHERE latitude>=1 AND latitude<=5 AND longitude>=2 AND longitude<=8""")
oracle("scan_axes", RASTER, select=f"""
SELECT 'latitude' AS array, ny-1-row AS idx, {_lat} AS label FROM (SELECT unnest(range(0,ny)) AS row FROM g), g
UNION ALL
SELECT 'longitude' AS array, col AS idx, {_lon} AS label FROM (SELECT unnest(range(0,nx)) AS col FROM g), g""")
oracle("assign_coords", POINTS, BOUNDS, SPEC, POINT_BURNS, select=f"""
SELECT layer, row, col, {label('row','lat_max','lat_min','ny')} AS latitude, {label('col','lon_min','lon_max','nx')} AS longitude
FROM (SELECT DISTINCT layer, row, col FROM burns) JOIN spec USING (layer)""")

# -- joins -------------------------------------------------------------------------

oracle("tile_join", *GRID, EDGES, TILE_HITS, select="SELECT layer, fid, tile_row, tile_col, tile_seq FROM hits")
oracle("rasterize_polygons", *GRID, EDGES, BURNS, select="SELECT layer, fid, row, col FROM burns")
oracle("rasterize_points", POINTS, BOUNDS, SPEC, POINT_BURNS, select="SELECT layer, fid, row, col, value FROM burns")
# every cell index on the longer axis, tested against both segment ends
oracle("rasterize_lines", LINES, BOUNDS, SPEC, select=f"""
, p AS (
  SELECT fid, nx, ny, (ux-lon_min)/dx AS ax, (lat_max-uy)/dy AS ay, (vx-lon_min)/dx AS bx, (lat_max-vy)/dy AS by_
  FROM ends JOIN spec USING (layer)),
m AS (
  SELECT fid, nx, ny, TRUE AS wide, ax AS a0, ay AS b0, bx AS a1, by_ AS b1 FROM p WHERE abs(bx-ax)>=abs(by_-ay)
  UNION ALL SELECT fid, nx, ny, FALSE, ay, ax, by_, bx FROM p WHERE abs(bx-ax)<abs(by_-ay)),
o AS (
  SELECT fid, nx, ny, wide, least(a0,a1) AS m0, greatest(a0,a1) AS m1,
    CASE WHEN a0<=a1 THEN b0 ELSE b1 END AS n0, CASE WHEN a0<=a1 THEN b1 ELSE b0 END AS n1 FROM m),
s AS (
  SELECT *, unnest(range(0, CASE WHEN wide THEN nx ELSE ny END)) AS k FROM o),
t AS (
  SELECT *, CAST(floor(n0+(least(m1,greatest(m0,CAST(k AS DOUBLE)+{HALF}))-m0)*(CASE WHEN m1>m0 THEN (n1-n0)/(m1-m0) ELSE 0 END)) AS BIGINT) AS n
  FROM s WHERE k+1>m0 AND k<=m1)
SELECT fid, CASE WHEN wide THEN n ELSE k END AS row, CASE WHEN wide THEN k ELSE n END AS col
FROM t WHERE n>=0 AND n<CASE WHEN wide THEN ny ELSE nx END""")
ORACLES["rasterize_lines"] = ORACLES["rasterize_lines"].replace("\n, p AS", ", p AS")
oracle("rasterize_lines_touched", LINES, BOUNDS, SPEC, """
pix AS (
  SELECT fid, nx, ny, (ux-lon_min)/dx AS ax, (lat_max-uy)/dy AS ay, (vx-lon_min)/dx AS bx, (lat_max-vy)/dy AS by_
  FROM ends JOIN spec USING (layer)),
down AS (
  SELECT fid, nx, ny, ax AS x0, ay AS y0, bx AS x1, by_ AS y1 FROM pix WHERE ay<by_ OR (ay=by_ AND ax<=bx)
  UNION ALL SELECT fid, nx, ny, bx, by_, ax, ay FROM pix WHERE NOT (ay<by_ OR (ay=by_ AND ax<=bx))),
lay AS (SELECT *, unnest(range(0, ny)) AS r FROM down),
passed AS (
  SELECT fid, nx, r, CASE WHEN r<=y0 THEN x0 ELSE x0+(CAST(r AS DOUBLE)-y0)*((x1-x0)/(y1-y0)) END AS xa,
    CASE WHEN r+1>=y1 THEN x1 ELSE x0+(CAST(r+1 AS DOUBLE)-y0)*((x1-x0)/(y1-y0)) END AS xb
  FROM lay WHERE r+1>y0 AND r<=y1),
clip AS (
  SELECT fid, r AS row, greatest(0, CAST(floor(least(xa,xb)) AS BIGINT)) AS c0,
    least(nx-1, CAST(floor(greatest(xa,xb)) AS BIGINT)) AS c1 FROM passed)""", select="""
SELECT fid, row, c0, c1 FROM clip WHERE c1>=c0""")
oracle("apply_codes", POLY, FIRST_CODES, select=f"""
SELECT p.layer, p.fid, CAST(c.code AS DOUBLE) AS code
FROM poly p JOIN codes c ON c.layer=p.layer AND c.category={filled('basic').replace('category','p.category')}""")
oracle("merge_outer", RASTER, THREE, select=f"""
SELECT y.latitude, x.longitude, coalesce(a.value, {NAN}) AS first, coalesce(b.value, {NAN}) AS second
FROM (SELECT DISTINCT latitude FROM lab) y CROSS JOIN (SELECT DISTINCT longitude FROM lab) x
LEFT JOIN (SELECT * FROM lab WHERE band=1) a ON a.latitude=y.latitude AND a.longitude=x.longitude
LEFT JOIN (SELECT * FROM lab WHERE band=2) b ON b.latitude=y.latitude AND b.longitude=x.longitude""")
oracle("merge_variables", *CELLS, FIRST_CODES, select=f"""
SELECT w.layer, w.row, w.col, CAST(c.code AS DOUBLE) AS category, coalesce({F32.format('p.price')}, {NAN}) AS price,
  CAST(p.size AS DOUBLE) AS size
FROM winners w JOIN poly p USING (fid) JOIN codes c ON c.layer=p.layer AND c.category={filled('basic').replace('category','p.category')}""")
oracle("features_in_circle", POLY, ZONES, DISC, select="SELECT zone_id, layer, fid FROM touch")
oracle("cells_in_zone", RASTER, ZONES, ZONE_CELLS, select="""
SELECT zone_id, band, row, col FROM covered JOIN ras USING (row, col)""")
oracle("compare_stores", RASTER, select=f"""
SELECT band, row, col, {F32.format('value')} AS store_value, value AS source_value,
  CASE WHEN isnan(value) THEN 0::BIGINT ELSE CAST(abs({F32.format('value')}-value)<=1e-8::DOUBLE+1e-5::DOUBLE*abs(value) AS BIGINT) END AS is_close
FROM ras""")

# -- aggregations ------------------------------------------------------------------

oracle("layer_bounds", POLY, BOUNDS, select="SELECT * FROM bounds")
oracle("distinct_categories", POLY, FIRST_CODES, select="SELECT layer, category, first_fid FROM firsts")
oracle("burn_replace", *CELLS, select="SELECT layer, row, col, fid FROM winners")
_extent = "SELECT layer, axis, min(label) AS min_label, max(label) AS max_label, count(*) AS n FROM axes GROUP BY layer, axis"
oracle("axis_extent", RASTER, RASTER_SPEC, AXIS_TABLE, select=_extent)
oracle("axis_step", RASTER, RASTER_SPEC, AXIS_TABLE, select=f"""
SELECT layer, axis, (max_label-min_label)/CAST(n AS DOUBLE) AS step FROM ({_extent})""")
oracle("variable_max", RASTER, select="SELECT band, max(value) AS max_value FROM ras WHERE NOT isnan(value) GROUP BY band")
oracle("strip_max", RASTER, select="""
SELECT band, row//20 AS strip, max(value) FILTER (WHERE NOT isnan(value)) AS max_value FROM ras GROUP BY ALL""")
oracle("majority_features", POLY, ZONES, DISC, select="""
SELECT zone_id, majority, n FROM (
  SELECT zone_id, CAST(size AS DOUBLE) AS majority, count(*) AS n,
    row_number() OVER (PARTITION BY zone_id ORDER BY count(*) DESC, size) AS k
  FROM touch JOIN poly USING (fid) GROUP BY zone_id, size) WHERE k=1""")
oracle("zonal_majority", RASTER, ZONES, ZONE_CELLS, select="""
SELECT zone_id, band, majority, n FROM (
  SELECT zone_id, band, floor(value/100000) AS majority, count(*) AS n,
    row_number() OVER (PARTITION BY zone_id, band ORDER BY count(*) DESC, floor(value/100000)) AS k
  FROM covered JOIN ras USING (row, col) WHERE NOT isnan(value) AND floor(value/100000)<>0
  GROUP BY zone_id, band, floor(value/100000)) WHERE k=1""")
oracle("feature_count", POINTS, select="SELECT layer, count(*) AS n FROM pts GROUP BY layer")
oracle("densify", RASTER, select="""
SELECT b.layer, r.row, c.col, coalesce(v.value, CAST(0 AS DOUBLE)) AS value
FROM (SELECT DISTINCT CAST(band AS VARCHAR) AS layer FROM ras) b,
     (SELECT unnest(range(0,ny)) AS row FROM g) r, (SELECT unnest(range(0,nx)) AS col FROM g) c
LEFT JOIN (SELECT CAST(band AS VARCHAR) AS layer, row, col, value FROM ras WHERE value>250000 AND NOT isnan(value)) v
  ON v.layer=b.layer AND v.row=r.row AND v.col=c.col""")
ORACLES["densify"] = with_(RASTER, select="""
, full_grid AS (
  SELECT b.layer, r.row, c.col FROM (SELECT DISTINCT CAST(band AS VARCHAR) AS layer FROM ras) b,
     (SELECT unnest(range(0,ny)) AS row FROM g) r, (SELECT unnest(range(0,nx)) AS col FROM g) c)
SELECT f.layer, f.row, f.col, coalesce(v.value, CAST(0 AS DOUBLE)) AS value
FROM full_grid f LEFT JOIN (SELECT CAST(band AS VARCHAR) AS layer, row, col, value FROM ras WHERE value>250000) v
  ON v.layer=f.layer AND v.row=f.row AND v.col=f.col""").replace("\n, full_grid", ", full_grid")
oracle("pack_chunks", RASTER, select="""
SELECT band, row//40 AS chunk_row, col//40 AS chunk_col, (row%40)*40+col%40 AS pos, value FROM ras""")
oracle("pack_chunks_auto", RASTER, """
full_band AS (SELECT max(n) AS n FROM (SELECT count(*) AS n FROM ras GROUP BY band)),
side AS (
  SELECT CAST(greatest(nx, ny) AS DOUBLE) AS longest,
    greatest(1, floor(sqrt(4096 / (least(CAST(1 AS DOUBLE), CAST(n AS DOUBLE)/CAST(nx*ny AS DOUBLE))*12)))) AS side
  FROM g, full_band),
size AS (SELECT CAST(ceil(longest/ceil(longest/side)) AS BIGINT) AS k FROM side)""", select="""
SELECT band, k AS chunk, row//k AS chunk_row, col//k AS chunk_col, (row%k)*k+col%k AS pos, value FROM ras, size""")
ORACLES["export_encoding"] = "SELECT CAST(p_partkey AS BIGINT) AS code, p_name||' '||p_partkey AS category FROM part"
oracle("category_map", POLY, FIRST_CODES, select="SELECT layer, 'category' AS var, category, code FROM codes")
oracle("infer_resolution", RASTER, RASTER_SPEC, AXIS_TABLE, select="""
SELECT abs(max(label)-min(label)) AS resolution FROM (
  SELECT DISTINCT label FROM axes WHERE axis='latitude' ORDER BY label LIMIT 2)""")

# -- numbering, sorts, limits ----------------------------------------------------------

oracle("codes_first_seen", POLY, FIRST_CODES, select="SELECT layer, category, code FROM codes")
oracle("codes_sorted", POLY, select=f"""
SELECT layer, 'None' AS category, 1::BIGINT AS code FROM (SELECT DISTINCT layer FROM poly)
UNION ALL
SELECT layer, category, 1+row_number() OVER (PARTITION BY layer ORDER BY category)
FROM (SELECT DISTINCT layer, {filled('zero')} AS category FROM poly) WHERE category<>'None'""")
oracle("codes_by_tile", *GRID, EDGES, TILE_HITS, select=f"""
SELECT layer, category, row_number() OVER (PARTITION BY layer ORDER BY t, category) AS code FROM (
  SELECT h.layer, {filled('strip')} AS category, min(h.tile_seq) AS t FROM hits h JOIN poly p USING (fid)
  GROUP BY h.layer, {filled('strip')})""")
oracle("index_matches", RASTER, select="""
SELECT band, row, col, row_number() OVER (PARTITION BY band ORDER BY row, col)-1 AS match FROM ras WHERE NOT isnan(value)""")
oracle("sort_latitude", RASTER, select="SELECT band, ny-1-row AS row, col, value FROM ras, g")
oracle("sample_cell", RASTER, select="""
SELECT seed::BIGINT AS seed, band, row, col, value FROM (
  SELECT seed, band, row, col, value, row_number() OVER (
    PARTITION BY seed ORDER BY md5(concat_ws(':', seed, band, row, col)), band, row, col) AS i
  FROM ras, (VALUES (0), (7), (8)) s(seed) WHERE NOT isnan(value))
WHERE i = 1""")

# -- set operations ----------------------------------------------------------------------

oracle("concat_tiles", RASTER, select="SELECT row, col+(band-1)*nx AS col, value FROM ras, g")
oracle("concat_strips", RASTER, select="SELECT row+(band-1)*ny AS row, col, value FROM ras, g")
oracle("union_axes", RASTER, THREE, select="""
SELECT DISTINCT 'latitude' AS axis, latitude AS label FROM lab UNION ALL
SELECT DISTINCT 'longitude', longitude FROM lab""")

# -- grid functions ------------------------------------------------------------------------

oracle("grid_spec", *GRID, select="SELECT * FROM spec")
oracle("axis_labels", *GRID, AXIS_TABLE, select="SELECT * FROM axes")
oracle("tile_grid", *GRID, select="""
SELECT layer, i//200 AS tile_row, j//200 AS tile_col,
  (i//200)*CAST(ceil(nx/CAST(200 AS DOUBLE)) AS BIGINT)+j//200 AS tile_seq, i AS row_off, j AS col_off,
  least(200, ny-i) AS height, least(200, nx-j) AS width,
  lon_min+CAST(j AS DOUBLE)*dx AS west, lat_max-CAST(i+least(200, ny-i) AS DOUBLE)*dy AS south,
  lon_min+CAST(j+least(200, nx-j) AS DOUBLE)*dx AS east, lat_max-CAST(i AS DOUBLE)*dy AS north
FROM (SELECT *, unnest(range(0,nx,200)) AS j FROM (SELECT *, unnest(range(0,ny,200)) AS i FROM spec))""")
oracle("circle_zone", ZONES, select="""
SELECT zone_id, i AS pos, round_even((cx+radius*cos(CAST(i%64 AS DOUBLE)*(2*pi()/64)))*1e9,0)/1e9 AS x,
  round_even((cy-radius*sin(CAST(i%64 AS DOUBLE)*(2*pi()/64)))*1e9,0)/1e9 AS y
FROM zone, (SELECT unnest(range(0,65)) AS i)""")
oracle("values_close", RASTER, select="""
SELECT band, row, col, CASE WHEN isnan(value) THEN 0::BIGINT
  ELSE CAST(abs(value-value*(1::DOUBLE+CAST(col%4 AS DOUBLE)*4e-6::DOUBLE))<=1e-8::DOUBLE+1e-5::DOUBLE*abs(value*(1::DOUBLE+CAST(col%4 AS DOUBLE)*4e-6::DOUBLE)) AS BIGINT) END AS is_close
FROM ras""")
oracle("title_of", TITLE, select="SELECT page_id, title FROM titled")
oracle("provenance", TITLE, select="""
SELECT page_id, 'Converted from '||title||', downloaded from '||url||', on 2024-01-01' AS history FROM titled""")

# -- metadata and quality --------------------------------------------------------------------


def _fixed_rows() -> str:
    # fixed values of the convention, written out apart from the library
    return (
        "('latitude','_CoordinateAxisType','Lat'),('latitude','axis','Y'),('latitude','long_name','latitude'),"
        "('latitude','standard_name','latitude'),('latitude','units','degrees_north'),"
        "('longitude','_CoordinateAxisType','Lon'),('longitude','axis','X'),('longitude','long_name','longitude'),"
        "('longitude','standard_name','longitude'),('longitude','units','degrees_east')"
    )


oracle("axis_metadata", *GRID, AXIS_TABLE, select=f"""
, e AS ({_extent})
SELECT layer, scope, key, 0::BIGINT AS pos, val AS text, CAST(-1 AS DOUBLE) AS number
FROM (SELECT DISTINCT layer FROM e), (VALUES {_fixed_rows()}) f(scope, key, val)
UNION ALL SELECT layer, axis, 'max', 0, '', max_label FROM e
UNION ALL SELECT layer, axis, 'min', 0, '', min_label FROM e
UNION ALL SELECT layer, axis, 'step', 0, '', (max_label-min_label)/CAST(n AS DOUBLE) FROM e""")
ORACLES["axis_metadata"] = ORACLES["axis_metadata"].replace("\n, e AS", ", e AS")
oracle("dataset_metadata", *GRID, AXIS_TABLE, select=f"""
, e AS (
  SELECT layer, min(label) FILTER (WHERE axis='longitude') AS w, min(label) FILTER (WHERE axis='latitude') AS s,
    max(label) FILTER (WHERE axis='longitude') AS e, max(label) FILTER (WHERE axis='latitude') AS n FROM axes GROUP BY layer),
r AS (
  SELECT layer, 'proj:epsg' AS key, 0::BIGINT AS pos, '' AS text, CAST(4326 AS DOUBLE) AS number FROM e
  UNION ALL SELECT layer, 'title', 0, 'parts_'||layer, -1 FROM e
  UNION ALL SELECT layer, 'Conventions', 0, 'CF-1.8', -1 FROM e
  UNION ALL SELECT layer, 'History', 0, 'Converted from parts_'||layer||', downloaded from file:///parts.zip, on 2024-01-01', -1 FROM e
  UNION ALL SELECT layer, 'history', 0, 'Converted on 2024-01-01', -1 FROM e
  UNION ALL SELECT layer, 'Comment', 0, 'Converted from parts_'||layer||', downloaded from file:///parts.zip, on 2024-01-01', -1 FROM e
  UNION ALL SELECT layer, 'resolution', 0, '', CAST(0.01 AS DOUBLE) FROM e
  UNION ALL SELECT layer, 'geographical_extent', 0, '', w FROM e UNION ALL SELECT layer, 'geographical_extent', 1, '', s FROM e
  UNION ALL SELECT layer, 'geographical_extent', 2, '', e FROM e UNION ALL SELECT layer, 'geographical_extent', 3, '', n FROM e
  UNION ALL SELECT layer, 'geospatial_lat_min', 0, '', s FROM e UNION ALL SELECT layer, 'geospatial_lat_max', 0, '', n FROM e
  UNION ALL SELECT layer, 'geospatial_lon_min', 0, '', w FROM e UNION ALL SELECT layer, 'geospatial_lon_max', 0, '', e FROM e)
SELECT layer, 'dataset' AS scope, key, pos, text, number FROM r""")
ORACLES["dataset_metadata"] = ORACLES["dataset_metadata"].replace("\n, e AS", ", e AS").replace("'', e FROM e", "'', e.e FROM e")
oracle("crs_metadata", POLY, select="""
SELECT layer, scope, '_CRS' AS key, 0::BIGINT AS pos, 'GEOGCS["WGS 84",AUTHORITY["EPSG","4326"]]' AS text, CAST(-1 AS DOUBLE) AS number
FROM (SELECT DISTINCT layer FROM poly), (VALUES ('category'),('price'),('size')) v(scope)""")
oracle("variable_metadata", POLY, RASTER, select="""
SELECT layer, 'dataset' AS scope, 'variables' AS key, pos, name AS text, CAST(-1 AS DOUBLE) AS number
FROM (SELECT DISTINCT layer FROM poly), (VALUES (0::BIGINT,'category'),(1,'price'),(2,'size')) v(pos, name)
UNION ALL SELECT layer, name, 'standard_name', 0, name, -1
FROM (SELECT DISTINCT layer FROM poly), (VALUES ('category'),('price'),('size')) v(name)
UNION ALL SELECT 'raster', 'dataset', 'band_count', 0, '', CAST(count(DISTINCT band) AS DOUBLE) FROM ras
UNION ALL SELECT DISTINCT 'raster', 'dataset', 'band_descriptions', band-1, r_name, CAST(-1 AS DOUBLE) FROM ras JOIN region ON r_regionkey+1=band""")
oracle("variable_status", POLY, select="""
SELECT layer, variable, CASE WHEN reason IN ('categorical','numeric') THEN 'converted' ELSE 'skipped' END AS status, reason, n_values, n_features, 0::BIGINT AS n_dropped
FROM (
  SELECT layer, 'category' AS variable, CASE WHEN count(category)=0 THEN 'no values' ELSE 'categorical' END AS reason, count(category) AS n_values, count(*) AS n_features FROM poly GROUP BY layer
  UNION ALL SELECT layer, 'price', CASE WHEN count(price)=0 THEN 'no values' ELSE 'numeric' END, count(price), count(*) FROM poly GROUP BY layer
  UNION ALL SELECT layer, 'size', CASE WHEN count(size)=0 THEN 'no values' ELSE 'numeric' END, count(size), count(*) FROM poly GROUP BY layer
  UNION ALL SELECT layer, 'partial', CASE WHEN layer='PROMO' THEN 'no values' ELSE 'numeric' END, CASE WHEN layer='PROMO' THEN 0 ELSE count(size) END, count(*) FROM poly GROUP BY layer
  UNION ALL SELECT layer, 'tags', 'unsupported type', count(*), count(*) FROM poly GROUP BY layer
  UNION ALL SELECT layer, 'unknown', 'not in schema', 0, count(*) FROM poly GROUP BY layer)""")

PICKED = f"""
sand AS (SELECT w.*, md5(concat_ws(':', '0', row, col)) AS k FROM winners w JOIN poly p USING (fid) WHERE p.size=20),
pick AS (SELECT layer, row, col FROM (
  SELECT layer, row, col, row_number() OVER (PARTITION BY layer ORDER BY k, row, col) AS i FROM sand) WHERE i=1),
zone AS (
  SELECT layer AS zone_id, {label('col','lon_min','lon_max','nx')} AS cx, {label('row','lat_max','lat_min','ny')} AS cy,
    CAST(0.1 AS DOUBLE) AS radius FROM pick JOIN spec USING (layer))"""
oracle("check_conversion", *CELLS, PICKED, DISC, select="""
, common AS (
  SELECT zone_id, size, row_number() OVER (PARTITION BY zone_id ORDER BY count(*) DESC, size) AS i
  FROM touch JOIN poly USING (fid) WHERE touch.layer=zone_id GROUP BY zone_id, size)
SELECT s.layer, CAST(s.m AS DOUBLE) AS source_max, CAST(w.m AS DOUBLE) AS grid_max, CAST(s.m=w.m AS BIGINT) AS same_max,
  z.cy AS latitude, z.cx AS longitude, CASE WHEN z.cy IS NOT NULL THEN CAST(20 AS DOUBLE) END AS cell_value,
  coalesce(CAST(c.size AS DOUBLE), -1) AS majority, coalesce(CAST(c.size=20 AS BIGINT), 0) AS agrees
FROM (SELECT layer, max(size) AS m FROM poly GROUP BY layer) s
LEFT JOIN (SELECT w.layer, max(p.size) AS m FROM winners w JOIN poly p USING (fid) GROUP BY w.layer) w ON w.layer=s.layer
LEFT JOIN zone z ON z.zone_id=s.layer
LEFT JOIN common c ON c.zone_id=s.layer AND c.i=1""")
ORACLES["check_conversion"] = ORACLES["check_conversion"].replace("\n, common", ", common")

# -- whole conversions -------------------------------------------------------------------------

oracle("convert_layers", *CELLS, FIRST_CODES, select=f"""
SELECT w.layer, s.ny-1-w.row AS row, w.col, CAST(c.code AS DOUBLE) AS code
FROM winners w JOIN spec s USING (layer) JOIN poly p USING (fid)
JOIN codes c ON c.layer=p.layer AND c.category={filled('basic').replace('category','p.category')}""")
oracle("convert_layers_tiled", *GRID, EDGES, BURNS, VALID, TILE_HITS, select=f"""
, tcodes AS (
  SELECT layer, category, row_number() OVER (PARTITION BY layer ORDER BY t, category) AS code FROM (
    SELECT h.layer, {filled('strip')} AS category, min(h.tile_seq) AS t FROM hits h JOIN poly p USING (fid)
    GROUP BY h.layer, {filled('strip')})),
last AS (SELECT layer, row, col, max(fid) AS fid FROM burns WHERE fid IN (SELECT fid FROM sound) GROUP BY ALL),
wide AS (
  SELECT w.layer, s.ny-1-w.row AS row, w.col, CAST(c.code AS DOUBLE) AS category,
    CASE WHEN p.price IS NULL OR isnan(p.price) THEN CAST(0 AS DOUBLE) ELSE {F32.format('p.price')} END AS price, CAST(p.size AS DOUBLE) AS size
  FROM last w JOIN spec s USING (layer) JOIN poly p USING (fid)
  JOIN tcodes c ON c.layer=p.layer AND c.category={filled('strip').replace('category','p.category')})
SELECT layer, 'category' AS var, row, col, category AS value FROM wide
UNION ALL SELECT layer, 'price', row, col, price FROM wide UNION ALL SELECT layer, 'size', row, col, size FROM wide""")
ORACLES["convert_layers_tiled"] = ORACLES["convert_layers_tiled"].replace("\n, tcodes", ", tcodes")
oracle("convert_raster", RASTER, select="""
SELECT 'raster' AS layer, 'depth_ratio_'||band AS var, ny-1-row AS row, col, value FROM ras, g""")
