"""DuckDB text of the same survey tables as ``views``."""

TAG = "list_extract(['camlower','cammid','camupper','HERC'], CAST(({n}) % 4 + 1 AS INTEGER))"


def _name(key: str, size: str) -> str:
    return (
        f"(CASE WHEN ({key}) % 3 = 0 THEN 'dive1/' ELSE '' END || {TAG.format(n=size)} || '_' || "
        f"lpad(CAST({key} AS VARCHAR), 12, '0') || '.jpg')"
    )


VIEWS = {
    "points": """
        SELECT o_orderkey AS point_id, (o_custkey % 1000) / 10.0::DOUBLE - 50 AS x,
               (o_orderkey % 977) / 10.0::DOUBLE - 48 AS y, (o_orderkey * 31 % 613) / 10.0::DOUBLE - 5 AS z,
               o_orderkey % 256 AS r, o_custkey % 256 AS g, (o_orderkey + o_custkey) % 256 AS b,
               o_totalprice / 100000 * (o_totalprice / 100000) AS error
        FROM orders""",
    "tracked": """
        SELECT p.*, coalesce(t.n, 0) AS track_length FROM points p
        LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1) t ON t.k = p.point_id""",
    "med": "SELECT median(error) AS m FROM points",
    "tiered": """
        SELECT *, CASE WHEN track_length >= 5 AND error < m THEN 1
                       WHEN track_length >= 3 AND error < 2 * m THEN 2
                       WHEN error < 3 * m THEN 3 ELSE 0 END AS tier
        FROM tracked, med""",
    "obs": """
        SELECT l_partkey AS image_id, CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS point_id,
               l_quantity * 40 AS px, l_discount * 10000 AS py FROM lineitem""",
    "images": f"""
        SELECT p_partkey AS image_id, {_name('p_partkey', 'p_size')} AS name, CAST(p_size % 4 AS BIGINT) AS camera_id,
               w / n AS qw, x / n AS qx, y / n AS qy, z / n AS qz,
               (p_partkey % 17) / 2.0::DOUBLE - 4 AS tx, (p_size % 13) / 4.0::DOUBLE AS ty, 40.0::DOUBLE + p_size AS tz, p_size
        FROM (SELECT *, sqrt(w * w + x * x + y * y + z * z) AS n
              FROM (SELECT *, 1.0::DOUBLE + p_size % 7 AS w, p_size % 5 - 2.0::DOUBLE AS x,
                           p_partkey % 3 - 1.0::DOUBLE AS y, (p_partkey % 11) / 10.0::DOUBLE AS z FROM part))""",
    "lens": """
        SELECT * FROM (VALUES (0, 2000.0::DOUBLE, 2010.0::DOUBLE, 1920.0::DOUBLE, 1080.0::DOUBLE),
            (1, 1800.0, 1800.0, 1920.0, 1080.0), (3, 1500.0, 1500.0, 960.0, 540.0)) v(camera_id, fx, fy, cx, cy)""",
    "cameras": """
        SELECT * FROM (VALUES (0::BIGINT, 'PINHOLE', 3840::BIGINT, 2160::BIGINT), (1, 'SIMPLE_PINHOLE', 3840, 2160),
            (2, 'OPENCV', 3840, 2160), (3, 'PINHOLE', 1920, 1080)) v(camera_id, model, width, height)""",
    "rules": """
        SELECT * FROM (VALUES (0, 'camlower', 'OPENCV', 16.0::DOUBLE, 36.0::DOUBLE), (1, 'cammid', 'OPENCV_FISHEYE', 12.0, 36.0),
            (2, 'towfish', 'PINHOLE', 20.0, 36.0), (3, 'HERC', 'OPENCV', 24.0, 36.0))
            v(rule_idx, prefix, model, focal_mm, sensor_width_mm)""",
    "framed": """
        SELECT o.image_id, o.point_id, o.px, o.py, i.camera_id, l.fx, l.fy, l.cx, l.cy,
          (1 - 2*qy*qy - 2*qz*qz) * x + (2*qx*qy - 2*qz*qw) * y + (2*qx*qz + 2*qy*qw) * z + tx AS cam_x,
          (2*qx*qy + 2*qz*qw) * x + (1 - 2*qx*qx - 2*qz*qz) * y + (2*qy*qz - 2*qx*qw) * z + ty AS cam_y,
          (2*qx*qz - 2*qy*qw) * x + (2*qy*qz + 2*qx*qw) * y + (1 - 2*qx*qx - 2*qy*qy) * z + tz AS cam_z
        FROM obs o JOIN points p ON o.point_id = p.point_id JOIN images i ON i.image_id = o.image_id
        JOIN lens l ON l.camera_id = i.camera_id""",
    "obs_err": """
        SELECT *, sqrt(power(fx * cam_x / cam_z + cx - px, 2) + power(fy * cam_y / cam_z + cy - py, 2)) AS obs_error
        FROM framed WHERE cam_z > 1e-6""",
    "splats": """
        SELECT vec_id AS splat_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z,
               embedding[4]::DOUBLE * 4 AS f0, embedding[5]::DOUBLE * 4 AS f1, embedding[6]::DOUBLE * 4 AS f2,
               embedding[7]::DOUBLE * 20 AS logit,
               embedding[8]::DOUBLE * 8 - 2 AS s0, embedding[9]::DOUBLE * 8 - 2 AS s1, embedding[10]::DOUBLE * 8 - 2 AS s2
        FROM embeddings""",
    "look": """
        SELECT *, 1 / (1 + exp(-logit)) AS opacity, greatest(exp(s0), exp(s1), exp(s2)) AS scale,
               least(greatest(f0 * 0.28209479177387814 + 0.5, 0), 1)::DOUBLE AS r,
               least(greatest(f1 * 0.28209479177387814 + 0.5, 0), 1)::DOUBLE AS g,
               least(greatest(f2 * 0.28209479177387814 + 0.5, 0), 1)::DOUBLE AS b
        FROM splats""",
    "hsv": """
        SELECT *, CASE WHEN hraw < 0 THEN hraw + 360 ELSE hraw END AS h,
               CASE WHEN mx > 0 THEN (mx - mn) / mx ELSE 0 END AS s, mx AS v
        FROM (SELECT *, CASE WHEN mx - mn > 1e-8 THEN 60 * CASE
                    WHEN mx = b THEN (r - g) / (mx - mn) + 4
                    WHEN mx = g THEN (b - r) / (mx - mn) + 2
                    ELSE (g - b) / (mx - mn) - 6 * floor((g - b) / (mx - mn) / 6) END ELSE 0 END AS hraw
              FROM (SELECT *, greatest(r, g, b) AS mx, least(r, g, b) AS mn FROM look))""",
    "nav": f"""
        SELECT CASE WHEN c_custkey % 2 = 0 THEN full_name ELSE regexp_replace(full_name, '^.*/', '') END AS name,
               c_acctbal AS x, c_acctbal * 0.5 + c_custkey AS y, (c_custkey % 40) / 4.0::DOUBLE - 650 AS alt,
               (c_custkey % 360)::DOUBLE AS yaw, 80.0::DOUBLE + c_custkey % 10 AS pitch, c_nationkey - 12.0::DOUBLE AS roll,
               CASE WHEN c_custkey % 5 <> 0 THEN 2.0::DOUBLE + c_custkey % 3 END AS x_acc,
               CASE WHEN c_custkey % 5 <> 0 THEN 3.0::DOUBLE + c_custkey % 4 END AS y_acc,
               CASE WHEN c_custkey % 5 <> 0 THEN 0.5::DOUBLE + c_custkey % 2 END AS alt_acc, c_custkey AS line_no
        FROM (SELECT c.*, {_name('c_custkey * 2', 'coalesce(p_size, c_custkey)')} AS full_name
              FROM customer c LEFT JOIN part ON p_partkey = c_custkey * 2)""",
    "nav_hit": """
        SELECT n.*, coalesce(f.image_id, b.image_id) AS image_id, coalesce(f.camera_id, b.camera_id) AS camera_id,
               CASE WHEN f.image_id IS NOT NULL THEN 'full' WHEN b.image_id IS NOT NULL THEN 'basename' END AS matched_by
        FROM nav n LEFT JOIN images f ON f.name = n.name
        LEFT JOIN images b ON regexp_replace(b.name, '^.*/', '') = n.name""",
    "keypoints": """
        SELECT p_partkey AS image_id, CASE WHEN p_partkey % 50 = 0 THEN 0 ELSE coalesce(n, 0) END AS rows
        FROM part LEFT JOIN (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1) ON k = p_partkey""",
    "matches": """
        SELECT least(a, b) AS image_id1, greatest(a, b) AS image_id2, CAST(sum(q) AS BIGINT) AS rows,
               CAST(sum(CASE WHEN flag <> 'R' THEN q ELSE 0 END) AS BIGINT) AS verified
        FROM (SELECT l_partkey AS a, (l_partkey + l_suppkey + 1) % (SELECT count(*) FROM part) AS b,
                     CAST(l_quantity AS BIGINT) AS q, l_returnflag AS flag FROM lineitem)
        WHERE a <> b GROUP BY 1, 2""",
    "sparse": """
        SELECT least(a, b) AS image_id1, greatest(a, b) AS image_id2
        FROM (SELECT l_partkey AS a, (l_partkey + l_suppkey + 1) % (SELECT count(*) FROM part) AS b, CAST(l_quantity AS BIGINT) AS q
              FROM lineitem WHERE l_linenumber = 7 AND l_returnflag = 'A' AND l_quantity <= 12)
        WHERE a <> b GROUP BY 1, 2 HAVING sum(q) > 0""",
    "stage_events": """
        SELECT event_id, user_id % 10 AS run_id, ts, value, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS counter,
               CASE event_type WHEN 'signup' THEN 'INITIALIZING' WHEN 'view' THEN 'FEATURE_EXTRACTION'
                    WHEN 'click' THEN 'MATCHING' WHEN 'purchase' THEN 'RECONSTRUCTION' WHEN 'error' THEN 'COMPLETE' END AS stage
        FROM events""",
    "gpu": "SELECT ts, event_type AS label, CAST(floor(value * 10) AS BIGINT) AS used_mib FROM events",
    "logs": """
        SELECT user_id % 10 AS run_id, event_id AS mtime,
               CASE event_type WHEN 'signup' THEN 'Feature Extraction' WHEN 'view' THEN 'Feature Matching'
                    WHEN 'click' THEN 'Global Mapper' WHEN 'purchase' THEN 'Incremental Mapper' ELSE 'Unknown Stage' END AS stage,
               CAST((event_id % 90) || '.' || (event_id % 10) AS DOUBLE) AS minutes
        FROM events WHERE event_id % 11 <> 0""",
}

NEEDS = {
    "tracked": ["points"], "med": ["points"], "tiered": ["tracked", "med"],
    "framed": ["obs", "points", "images", "lens"], "obs_err": ["framed"],
    "look": ["splats"], "hsv": ["look"], "nav_hit": ["nav", "images"],
}


def with_views(*names: str, recursive: bool = False) -> str:
    """A WITH clause of the named views and what they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in NEEDS.get(name, []):
            add(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ", ".join(f"{n} AS ({VIEWS[n]})" for n in ordered) + " "
