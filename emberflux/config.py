"""Fixed values and choices of the emissions library, in one place."""

from __future__ import annotations

from pyspark.sql import types as T

# The measures that a grid payload delivers, in the order in which they are collected.
GRID_VARIABLES = (
    "thermal_generation",
    "gas_generation",
    "g_co2_per_kwh",
    "hydro_generation",
    "nuclear_generation",
    "renewable_generation",
    "tons_co2",
    "total_generation",
    "tons_co2_per_mwh",
    "demand_met",
    "net_demand",
)

GRID_SCHEMA = T.StructType([T.StructField("timestamp", T.TimestampNTZType()), *(T.StructField(v, T.DoubleType()) for v in GRID_VARIABLES)])

# Spellings that stand for a provider, a dataset, a boolean.
PROVIDERS = {
    "cds": "cds",
    "copernicus": "cds",
    "copernicus climate": "cds",
    "copernicus data store": "cds",
    "copernicus climate data store": "cds",
    "era5": "cds",
    "1": "cds",
    "open-meteo": "open-meteo",
    "openmeteo": "open-meteo",
    "om": "open-meteo",
    "open": "open-meteo",
    "2": "open-meteo",
}
DATASETS = {
    "era5land": "era5-land",
    "era5-land": "era5-land",
    "land": "era5-land",
    "0.1": "era5-land",
    "1": "era5-land",
    "era5-world": "era5-world",
    "era5_world": "era5-world",
    "world": "era5-world",
    "era5": "era5-world",
    "0.25": "era5-world",
    "2": "era5-world",
}
BOOLEANS = {
    "yes": True,
    "y": True,
    "1": True,
    "true": True,
    "t": True,
    "on": True,
    "no": False,
    "n": False,
    "0": False,
    "false": False,
    "f": False,
    "off": False,
}
RESOLUTION = {"era5-world": 0.25, "era5-land": 0.1}
# The store's names of the datasets.
PRODUCTS = {"era5-world": "reanalysis-era5-single-levels", "era5-land": "reanalysis-era5-land"}

# Variables that the world dataset does not deliver.
DENIED_WORLD = (
    "fraction_of_cloud_cover",
    "large_scale_precipitation",
    "snow_density",
    "snow_depth",
    "snowfall",
    "surface_runoff",
    "sub_surface_runoff",
    "total_evaporation",
    "volumetric_soil_water_layer_1",
    "volumetric_soil_water_layer_2",
    "volumetric_soil_water_layer_3",
    "volumetric_soil_water_layer_4",
    "skin_reservoir_content",
    "temperature_of_snow_layer",
    "soil_temperature_level_1",
    "soil_temperature_level_2",
    "soil_temperature_level_3",
    "soil_temperature_level_4",
)

# The size and time models of monthly extracts.
SIZE_MB, SIZE_VARIABLES, SIZE_DEGREES, SIZE_RESOLUTION, SIZE_LEAST_MB = 0.509, 2, 6.0, 0.25, 0.05
BASE_SECONDS, UNITS_PER_SECOND, SERVER_MBPS, SAFETY, PARALLEL_EFFICIENCY = 30.0, 8e6, 400.0, 5.0, 0.6
MOST_RETRIES, MOST_DELAY, MOST_PARALLEL, LAG_DAYS = 20, 3600, 8, 8

# Choices where no rule is given.
SUNNY_SSRD = 200_000.0
DAYS_PER_YEAR = 365.25
CONFIDENCE_LOW, CONFIDENCE_HIGH = 0.40, 0.60
SPLINES, PENALTY = 20, 50.0
