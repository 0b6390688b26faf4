"""Lists, limits and formats that results depend on."""

# Hourly variables of the raw payload, and the column each one becomes in staging.
HOURLY_MEASURES = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "relative_humidity_pct",
    "dew_point_2m": "dew_point_c",
    "apparent_temperature": "apparent_temperature_c",
    "precipitation": "precipitation_mm",
    "rain": "rain_mm",
    "pressure_msl": "pressure_msl_hpa",
    "surface_pressure": "surface_pressure_hpa",
    "cloud_cover": "cloud_cover_pct",
    "wind_speed_10m": "wind_speed_kmh",
    "wind_direction_10m": "wind_direction_deg",
    "wind_gusts_10m": "wind_gusts_kmh",
    "shortwave_radiation": "shortwave_radiation_w_m2",
}

# Where feeds disagree on an hour: the pulled ones count alike, the live sensors only fill gaps.
FEED_RANKS = {"historical": 1, "daily": 1, "streaming": 0}

# The six pollutants that are kept.
POLLUTANTS = ["pm25", "pm10", "o3", "no2", "so2", "co"]

# (pollutants, unit they must be reported in, factor to the normalised unit, normalised unit)
UNIT_RULES = [
    (["pm25", "pm10"], "µg/m³", 1, "µg/m³"),
    (["o3", "no2", "so2"], "ppb", 1, "ppb"),
    (["co"], "ppm", 1000, "ppb"),
]

# Daily health guideline per pollutant, in the normalised unit; a median above it exceeds.
GUIDELINES = {"pm25": 15, "pm10": 45, "no2": 25, "so2": 40, "o3": 100, "co": 4000}

# Climate zone: first upper elevation bound (metres, exclusive) that fits.
CLIMATE_ZONES = [
    (500, "tierra_caliente"),
    (1000, "tierra_templada"),
    (2000, "tierra_fria"),
    (3000, "tierra_muy_fria"),
]
TOP_CLIMATE_ZONE = "paramo"

# Population tier: first upper population bound (exclusive) that fits.
POPULATION_TIERS = [(600000, "medium"), (2000000, "large")]
TOP_POPULATION_TIER = "metropolitan"

# Event flags of a weather day.
HEAVY_RAIN_ABOVE_MM = 20
HOT_FROM_C = 32
COLD_UP_TO_C = 5
WINDY_FROM_KMH = 40
HOURS_PER_COMPLETE_DAY = 24

# Stress score: heat points per degree above a base, points per unit of a pollutant, and caps.
HEAT_BASE_C, HEAT_POINTS_PER_C, HEAT_CAP = 28, 3, 30
POLLUTANT_POINTS = [("pm25", 1.2, 35), ("o3", 0.2, 20), ("no2", 0.5, 15)]
SCORE_CAP = 100

# Text that stands for NULL inside a surrogate key, and the separator between key parts.
KEY_NULL_TEXT = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

# City dimension: city_id, name, department, latitude, longitude, elevation_m, population, timezone
CITIES = [
    ("BOG", "Bogota", "Cundinamarca", 4.7110, -74.0721, 2640, 7743955, "America/Bogota"),
    ("MDE", "Medellin", "Antioquia", 6.2442, -75.5812, 1495, 2569007, "America/Bogota"),
    ("CLO", "Cali", "Valle del Cauca", 3.4516, -76.5320, 1000, 2227642, "America/Bogota"),
    ("BAQ", "Barranquilla", "Atlantico", 10.9639, -74.7964, 18, 1274250, "America/Bogota"),
    ("CTG", "Cartagena", "Bolivar", 10.3910, -75.4794, 2, 1055082, "America/Bogota"),
    ("BGA", "Bucaramanga", "Santander", 7.1193, -73.1227, 959, 614540, "America/Bogota"),
    ("PEI", "Pereira", "Risaralda", 4.8133, -75.6961, 1411, 482109, "America/Bogota"),
    ("SMR", "Santa Marta", "Magdalena", 11.2408, -74.1990, 6, 499192, "America/Bogota"),
]
