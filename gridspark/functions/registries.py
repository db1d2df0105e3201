"""The fixed names of the power-market and weather domain, and columns made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Production types by code.
PSR_TYPES = {
    "B01": "Biomass",
    "B02": "Fossil Brown coal/Lignite",
    "B03": "Fossil Coal-derived gas",
    "B04": "Fossil Gas",
    "B05": "Fossil Hard coal",
    "B06": "Fossil Oil",
    "B07": "Fossil Oil shale",
    "B08": "Fossil Peat",
    "B09": "Geothermal",
    "B10": "Hydro Pumped Storage",
    "B11": "Hydro Run-of-river and poundage",
    "B12": "Hydro Water Reservoir",
    "B13": "Marine",
    "B14": "Nuclear",
    "B15": "Other renewable",
    "B16": "Solar",
    "B17": "Waste",
    "B18": "Wind Offshore",
    "B19": "Wind Onshore",
    "B20": "Other",
    "B25": "Energy storage",
}

#: Columns of the full generation table, one for each production type.
GENERATION_COLUMNS = {
    "Biomass": "biomass_mw",
    "Energy storage": "energy_storage_mw",
    "Fossil Brown coal/Lignite": "fossil_brown_coal_mw",
    "Fossil Coal-derived gas": "fossil_coal_derived_gas_mw",
    "Fossil Gas": "fossil_gas_mw",
    "Fossil Hard coal": "fossil_hard_coal_mw",
    "Fossil Oil": "fossil_oil_mw",
    "Fossil Oil shale": "fossil_oil_shale_mw",
    "Fossil Peat": "fossil_peat_mw",
    "Geothermal": "geothermal_mw",
    "Hydro Pumped Storage": "hydro_pumped_mw",
    "Hydro Run-of-river and poundage": "hydro_run_mw",
    "Hydro Water Reservoir": "hydro_reservoir_mw",
    "Marine": "marine_mw",
    "Nuclear": "nuclear_mw",
    "Other": "other_mw",
    "Other renewable": "other_renewable_mw",
    "Solar": "solar_mw",
    "Waste": "waste_mw",
    "Wind Offshore": "wind_offshore_mw",
    "Wind Onshore": "wind_onshore_mw",
}

#: The renewable table folds eleven types into eight columns.
RENEWABLE_COLUMNS = {
    "Solar": "solar_mw",
    "Wind Onshore": "wind_onshore_mw",
    "Wind Offshore": "wind_offshore_mw",
    "Hydro Run-of-river and poundage": "hydro_run_mw",
    "Hydro Water Reservoir": "hydro_reservoir_mw",
    "Hydro Pumped Storage": "hydro_reservoir_mw",
    "Biomass": "biomass_mw",
    "Geothermal": "geothermal_mw",
    "Energy storage": "other_renewable_mw",
    "Other renewable": "other_renewable_mw",
    "Marine": "other_renewable_mw",
}

#: Columns of the wind and solar forecast.
FORECAST_COLUMNS = {"Solar": "solar_mw", "Wind Onshore": "wind_onshore_mw", "Wind Offshore": "wind_offshore_mw"}

#: Countries of bidding zones.
ZONE_TO_COUNTRY = {
    "DE_AT_LU": "DE",
    "DE_LU": "DE",
    "IT_NORD": "IT",
    "IT_CNOR": "IT",
    "IT_CSUD": "IT",
    "IT_SUD": "IT",
    "IT_SARD": "IT",
    "IT_SICI": "IT",
    "IT_NORD_AT": "IT",
    "IT_NORD_FR": "IT",
    "IT_NORD_SI": "IT",
    "IT_NORD_CH": "IT",
    "IT_BRNN": "IT",
    "IT_FOGN": "IT",
    "IT_GR": "IT",
    "IT_PRGP": "IT",
    "IT_ROSN": "IT",
    "IT_CALA": "IT",
    "DK_1": "DK",
    "DK_2": "DK",
    "SE_1": "SE",
    "SE_2": "SE",
    "SE_3": "SE",
    "SE_4": "SE",
    "NO_1": "NO",
    "NO_2": "NO",
    "NO_3": "NO",
    "NO_4": "NO",
    "NO_5": "NO",
    "GB": "GB",
    "GB_NIR": "GB",
    "IE_SEM": "IE",
}

#: The zone that is asked for a country, by purpose.
ZONES_BY_PURPOSE = {
    "price": {"DE": ["DE_LU"], "LU": ["DE_LU"], "AT": ["AT"], "IT": ["IT_NORD"], "NO": ["NO_1", "NO_2", "NO_3", "NO_4", "NO_5"], "SE": ["SE_1", "SE_2", "SE_3", "SE_4"], "DK": ["DK_1", "DK_2"]},
    "net_position": {"DE": ["DE_LU"], "LU": ["DE_LU"]},
    "flow": {"DE": ["DE_LU"]},
}
#: Countries whose additive series is stored under another country already.
DUPLICATE_COUNTRIES = {"net_position": ["LU"]}

#: Columns of weather variables. Shares come as per cent; everything else is kept, kelvin only where asked for.
WEATHER_COLUMNS = {
    "shortwave_radiation": "shortwave_radiation_wm2",
    "direct_radiation": "direct_radiation_wm2",
    "direct_normal_irradiance": "direct_normal_irradiance_wm2",
    "diffuse_radiation": "diffuse_radiation_wm2",
    "global_tilted_irradiance": "global_tilted_irradiance_wm2",
    "terrestrial_radiation": "terrestrial_radiation_wm2",
    "shortwave_radiation_instant": "shortwave_radiation_instant_wm2",
    "direct_radiation_instant": "direct_radiation_instant_wm2",
    "direct_normal_irradiance_instant": "direct_normal_irradiance_instant_wm2",
    "diffuse_radiation_instant": "diffuse_radiation_instant_wm2",
    "global_tilted_irradiance_instant": "global_tilted_irradiance_instant_wm2",
    "terrestrial_radiation_instant": "terrestrial_radiation_instant_wm2",
    "cloud_cover": "cloud_cover_frac",
    "cloud_cover_low": "cloud_cover_low_frac",
    "cloud_cover_mid": "cloud_cover_mid_frac",
    "cloud_cover_high": "cloud_cover_high_frac",
    "sunshine_duration": "sunshine_duration_s",
    "temperature_2m": "temperature_2m_c",
    "dew_point_2m": "dew_point_2m_c",
    "relative_humidity_2m": "relative_humidity_2m_frac",
    "pressure_msl": "pressure_msl_hpa",
    "wind_speed_10m": "wind_speed_10m_ms",
    "wind_direction_10m": "wind_direction_10m_deg",
    "wind_gusts_10m": "wind_gusts_10m_ms",
    "wind_speed_100m": "wind_speed_100m_ms",
    "precipitation": "precip_mm",
    "rain": "rain_mm",
    "snowfall": "snowfall_mm",
}
#: Columns that only a single place is asked for, and all variables that it is asked for.
POINT_ONLY_COLUMNS = {"wind_direction_100m": "wind_direction_100m_deg", "wind_speed_80m": "wind_speed_80m_ms", "wind_speed_120m": "wind_speed_120m_ms"}
POINT_VARIABLES = [
    "temperature_2m", "dew_point_2m", "relative_humidity_2m", "pressure_msl", "wind_speed_10m", "wind_gusts_10m", "wind_direction_10m", "wind_speed_100m", "wind_direction_100m",
    "wind_speed_80m", "wind_speed_120m", "precipitation", "rain", "snowfall", "shortwave_radiation", "direct_radiation", "direct_normal_irradiance", "diffuse_radiation",
]
#: Inclusive boxes of regional weather models, as (lat_min, lat_max, lon_min, lon_max); other models are global.
MODEL_BOXES = {"knmi_harmonie_arome_europe": (42.0, 65.0, -12.0, 22.0), "meteofrance_arome_france": (38.0, 56.0, -10.0, 13.0)}


def production_type(code: Column) -> Column:
    """The name of a production type; an unknown code stays as it is."""
    return F.coalesce(F.create_map(*(F.lit(x) for kv in PSR_TYPES.items() for x in kv))[code], code)


def country_of(zone: Column) -> Column:
    """The country of a bidding zone; two-letter codes and unknown names pass."""
    return F.coalesce(F.create_map(*(F.lit(x) for kv in ZONE_TO_COUNTRY.items() for x in kv))[zone], zone)


def zones_of(df: DataFrame, country_col: str, purpose: str, out: str = "zone") -> DataFrame:
    """A row for each zone that a country's series of this purpose is made of; other countries are their own zone."""
    known = F.create_map(*(x for c, zones in ZONES_BY_PURPOSE[purpose].items() for x in (F.lit(c), F.array(*map(F.lit, zones)))))
    return df.withColumn(out, F.explode(F.coalesce(known[F.col(country_col)], F.array(F.col(country_col)))))


def without_duplicates(df: DataFrame, country_col: str, measure: str) -> DataFrame:
    """Without countries that would count an additive measure twice; measures that don't add up keep all countries."""
    return df.filter(~F.col(country_col).isin(DUPLICATE_COUNTRIES.get(measure, [])))


def weather_units(kelvin: bool = False) -> dict[str, tuple[str, float, float]]:
    """{variable: (column, scale, offset)} for ``shape.convert_units``; with ``kelvin``, temperatures are shifted and named so."""
    out = {}
    for variable, column in WEATHER_COLUMNS.items():
        warm = kelvin and column.endswith("_c")
        out[variable] = (column[:-2] + "_k" if warm else column, 0.01 if column.endswith("_frac") else 1.0, 273.15 if warm else 0.0)
    return out


def point_units() -> dict[str, tuple[str, float, float]]:
    """{variable: (column, scale, offset)} of what a single place is asked for, temperatures in kelvin."""
    known = weather_units(kelvin=True) | {v: (c, 1.0, 0.0) for v, c in POINT_ONLY_COLUMNS.items()}
    return {v: known[v] for v in POINT_VARIABLES}
