"""Table schemas of the survey model."""

CAMERAS = "camera_id BIGINT, model STRING, width INT, height INT, params ARRAY<DOUBLE>"
IMAGES = "image_id BIGINT, name STRING, camera_id BIGINT, qvec ARRAY<DOUBLE>, tvec ARRAY<DOUBLE>"
OBSERVATIONS = "image_id BIGINT, obs_idx INT, px DOUBLE, py DOUBLE, point_id BIGINT"
TRACK = "ARRAY<STRUCT<image_id: BIGINT, point2d_idx: INT>>"
POINTS = (
    "point_id BIGINT, x DOUBLE, y DOUBLE, z DOUBLE, r INT, g INT, b INT, error DOUBLE, "
    f"track_length INT, track {TRACK}"
)
NAV = (
    "name STRING, x DOUBLE, y DOUBLE, alt DOUBLE, yaw DOUBLE, pitch DOUBLE, roll DOUBLE, "
    "x_acc DOUBLE, y_acc DOUBLE, alt_acc DOUBLE"
)
CAMERA_RULES = "rule_idx INT, prefix STRING, model STRING, focal_mm DOUBLE, sensor_width_mm DOUBLE"
QUALITY_REPORT = (
    "component STRUCT<medianError: DOUBLE, meanError: DOUBLE, avgTrackLength: DOUBLE, "
    "totalProjections: BIGINT, cameraCount: BIGINT>, "
    "cameras ARRAY<STRUCT<image: STRING, numPoints: BIGINT, imageCoverage: DOUBLE, "
    "reprojError: STRUCT<median: DOUBLE, mean: DOUBLE, max: DOUBLE, stdev: DOUBLE, mode: DOUBLE>>>"
)
GPU_SAMPLES = "timestamp BIGINT, label STRING, used_mib INT, free_mib INT, total_mib INT"
CLEANING = (
    "source STRING, clean_config STRING, input_splats BIGINT, output_splats BIGINT, "
    "removed_pct DOUBLE, time_sec BIGINT, output_file STRING"
)
RUNS = (
    "label STRING, time_sec BIGINT, peak_vram_mib BIGINT, net_vram_mib BIGINT, "
    "splat_count BIGINT, ply_size_bytes BIGINT, psnr STRING"
)
RUN_FILE = (
    "timestamp STRING, dataset STRING, gpu STRING, baseline_vram_mib BIGINT, resize_factor INT, "
    "runs ARRAY<STRUCT<label: STRING, time_sec: BIGINT, peak_vram_mib: BIGINT, net_vram_mib: BIGINT, "
    "splat_count: BIGINT, ply_size_bytes: BIGINT, psnr: STRING>>"
)
