"""Fixed values of the scoring method; results depend on them as they stand."""

FLAT_THRESHOLD_DEG = 10.0
SUN_FACING = (90.0, 270.0)
MAX_SLOPE_DEG = 45.0
MIN_INSOLATION = 800.0
MIN_USABLE_M2 = 30.0
UTILIZATION = 0.70
SETBACK = 0.85
FLAT_GCR = 0.50
OBSTRUCTION_TAU_M = 0.5
REAL_SKY, MODULE_EFF, PERFORMANCE_RATIO, POWER_DENSITY, GRID_CO2 = 0.75, 0.20, 0.80, 0.20, 0.35
MIN_PX, MAX_PLANES, MIN_PLANE_PX, RESIDUAL_M, SUPERSTRUCTURE_MAX_PX = 6, 4, 8, 0.5, 25
DAYS_IN_MONTH = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
MID_MONTH_DAYS = (15, 45, 74, 105, 135, 162, 198, 228, 258, 288, 319, 349)
NODATA = -9999.0
GRID_ORIGIN, TILE_SIZE_M, TILE_BUFFER_M = (315000.0, 4295000.0), 2000.0, 300.0
BENCHMARK_KWH_PER_KWP, BENCHMARK_TOLERANCE = 1150.0, 0.15
SEVERAL_PLANES = 3
SPOT_MIN_AREA_M2 = 50.0
PLANE_TOLERANCE = 1
#: Fitting methods of the spot check, with the facets that each may fit.
METHODS = {"multiplane": 4, "ransac": 1}
ROOF_TYPES = ("flat", "gable", "hip", "complex")
REASONS = ("no_plane_fit", "too_steep", "north_facing", "low_insolation", "too_small")
