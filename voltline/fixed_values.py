"""Names, ids and lists that must equal the public sources' own."""

from __future__ import annotations

# SMARD variable ids with their series name and description, in catalogue order.
# (series, variable id, description)
GENERATION = [
    ("smard_generation_solar", 4068, "Solar generation"),
    ("smard_generation_wind_onshore", 4067, "Onshore wind generation"),
    ("smard_generation_wind_offshore", 1225, "Offshore wind generation"),
    ("smard_generation_brown_coal", 1223, "Brown coal generation"),
    ("smard_generation_hard_coal", 4069, "Hard coal generation"),
    ("smard_generation_nuclear", 1224, "Nuclear generation"),
    ("smard_generation_natural_gas", 4071, "Natural gas generation"),
    ("smard_generation_hydro", 1226, "Hydro generation"),
    ("smard_generation_biomass", 4066, "Biomass generation"),
    ("smard_generation_pumped_storage", 4070, "Pumped-storage generation"),
    ("smard_generation_other_conventional", 1227, "Other conventional generation"),
    ("smard_generation_other_renewable", 1228, "Other renewable generation"),
]
CONSUMPTION = [
    ("smard_load", 410, "Total grid load"),
    ("smard_consumption_residual_load", 4359, "Residual load"),
    ("smard_consumption_pumped_storage_load", 4387, "Pumped-storage load"),
]
PRICES = [
    ("smard_price_de_lu", 4169, "Day-ahead price, DE-LU"),
    ("smard_price_de_lu_neighbors", 5078, "Day-ahead price, neighbours of DE-LU"),
    ("smard_price_at", 4170, "Day-ahead price, Austria"),
    ("smard_price_be", 4996, "Day-ahead price, Belgium"),
    ("smard_price_ch", 259, "Day-ahead price, Switzerland"),
    ("smard_price_cz", 261, "Day-ahead price, Czechia"),
    ("smard_price_dk1", 252, "Day-ahead price, Denmark 1"),
    ("smard_price_dk2", 253, "Day-ahead price, Denmark 2"),
    ("smard_price_fr", 254, "Day-ahead price, France"),
    ("smard_price_hu", 262, "Day-ahead price, Hungary"),
    ("smard_price_it_north", 255, "Day-ahead price, Northern Italy"),
    ("smard_price_nl", 256, "Day-ahead price, Netherlands"),
    ("smard_price_no2", 4997, "Day-ahead price, Norway 2"),
    ("smard_price_pl", 257, "Day-ahead price, Poland"),
    ("smard_price_pl2", 258, "Day-ahead price, Poland, second series"),
    ("smard_price_si", 260, "Day-ahead price, Slovenia"),
]
FORECASTS = [
    ("smard_forecast_total", 122, "Generation forecast, total"),
    ("smard_forecast_onshore", 123, "Generation forecast, onshore wind"),
    ("smard_forecast_offshore", 3791, "Generation forecast, offshore wind"),
    ("smard_forecast_solar", 125, "Generation forecast, solar"),
    ("smard_forecast_wind_solar", 5097, "Generation forecast, wind and solar"),
    ("smard_forecast_other", 715, "Generation forecast, other"),
]
CAPACITIES = [
    ("smard_capacity_solar", 188, "Installed solar capacity"),
    ("smard_capacity_wind_onshore", 186, "Installed onshore wind capacity"),
    ("smard_capacity_wind_offshore", 4076, "Installed offshore wind capacity"),
    ("smard_capacity_brown_coal", 4072, "Installed brown coal capacity"),
    ("smard_capacity_hard_coal", 4075, "Installed hard coal capacity"),
    ("smard_capacity_natural_gas", 198, "Installed natural gas capacity"),
    ("smard_capacity_hydro", 3792, "Installed hydro capacity"),
    ("smard_capacity_biomass", 189, "Installed biomass capacity"),
    ("smard_capacity_pumped_storage", 4074, "Installed pumped-storage capacity"),
    ("smard_capacity_other_renewable", 194, "Installed other renewable capacity"),
]

# Redispatch by energy source: chart ids and the column order of the headerless CSV.
REDISPATCH_CHARTS = {"s-nepm_re_et-1-1": "reduction", "s-nepm_re_et-1-2": "increase"}
REDISPATCH_SOURCES = [
    "Wind_Offshore", "Wind_Onshore", "Braunkohle", "Photovoltaik", "Steinkohle", "Erdgas", "Kernenergie",
    "Biomasse", "Pumpspeicher", "Wasserkraft", "Sonstige_Erneuerbare", "Sonstige_Konventionelle", "Unbekannt",
]

# Known, investigated gaps as (series, stamp, reason).
KNOWN_HOURLY_GAPS = [
    ("smard_load", "2018-10-08 16:00", "null at source"),
    ("smard_load", "2018-10-28 01:00", "null at source"),
    ("smard_load", "2018-10-30 11:00", "null at source"),
    ("smard_capacity_wind_onshore", "2017-10-29 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_wind_offshore", "2015-10-25 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_wind_offshore", "2016-10-30 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_wind_offshore", "2017-10-29 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_brown_coal", "2015-10-25 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_brown_coal", "2016-10-30 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_brown_coal", "2017-10-29 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_hard_coal", "2015-10-25 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_hard_coal", "2016-10-30 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_hard_coal", "2017-10-29 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_natural_gas", "2016-10-30 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_natural_gas", "2017-10-29 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_pumped_storage", "2015-10-25 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_pumped_storage", "2016-10-30 00:00", "absent at source on the autumn clock change"),
    ("smard_capacity_pumped_storage", "2017-10-29 00:00", "absent at source on the autumn clock change"),
    ("smard_forecast_onshore", "2023-10-28 22:00", "absent at source on the evening before the autumn clock change"),
    ("smard_forecast_onshore", "2024-10-26 22:00", "absent at source on the evening before the autumn clock change"),
    ("smard_forecast_onshore", "2025-10-25 22:00", "absent at source on the evening before the autumn clock change"),
    ("smard_forecast_solar", "2023-10-28 22:00", "absent at source on the evening before the autumn clock change"),
    ("smard_forecast_solar", "2024-10-26 22:00", "absent at source on the evening before the autumn clock change"),
    ("smard_forecast_solar", "2025-10-25 22:00", "absent at source on the evening before the autumn clock change"),
    ("smard_forecast_wind_solar", "2023-10-28 22:00", "absent at source on the evening before the autumn clock change"),
    ("smard_forecast_wind_solar", "2024-10-26 22:00", "absent at source on the evening before the autumn clock change"),
    ("smard_forecast_wind_solar", "2025-10-25 22:00", "absent at source on the evening before the autumn clock change"),
    ("smard_consumption_residual_load", "2018-10-08 16:00", "null at source, inherited from the load"),
    ("smard_consumption_residual_load", "2018-10-28 01:00", "null at source, inherited from the load"),
    ("smard_consumption_residual_load", "2018-10-30 11:00", "null at source, inherited from the load"),
]
KNOWN_DAILY_GAPS = [("fcr_capacity_price", "2021-10-03 00:00", "absent from the source's own monthly file")]

# Series whose gaps are a known trait of the source: warn, do not fail.
WARN_ONLY_SERIES = ["nrv_saldo"]

# First day each source can deliver.
SOURCE_STARTS = {
    "smard": "2015-01-01",
    "rebap_price": "2014-01-01",
    "nrv_saldo": "2014-01-01",
    "id_aep": "2020-07-01",
    "aep_modules": "2022-06-22",
    "fcr_capacity_price": "2021-01-01",
    "afrr_capacity_price": "2018-10-01",
}
REFRESH_DAYS = {"rebap_price": 14, "nrv_saldo": 14, "aep_modules": 14, "id_aep": 3}

# Four-hour delivery blocks, and the price columns the tender files have used.
BLOCKS = ["00_04", "04_08", "08_12", "12_16", "16_20", "20_24"]
FCR_PRICE_COLUMNS = ["GERMANY_SETTLEMENTCAPACITY_PRICE_[EUR/MW]", "DE_SETTLEMENTCAPACITY_PRICE_[EUR/MW]"]
AFRR_PRICE_PER_HOUR = "GERMANY_MARGINAL_CAPACITY_PRICE_[(EUR/MW)/h]"
AFRR_PRICE_PER_BLOCK = "GERMANY_MARGINAL_CAPACITY_PRICE_[EUR/MW]"

# Registry: source column -> column here.
REGISTRY_COMMON = {
    "EinheitMastrNummer": "unit_id",
    "Energietraeger": "energy_source",
    "Bundesland": "state",
    "Landkreis": "district",
    "Gemeindeschluessel": "municipality_key",
    "Postleitzahl": "postal_code",
    "Laengengrad": "longitude",
    "Breitengrad": "latitude",
    "Nettonennleistung": "net_capacity_kw",
    "Bruttoleistung": "gross_capacity_kw",
    "Inbetriebnahmedatum": "commissioning_date",
    "GeplantesInbetriebnahmedatum": "planned_commissioning_date",
    "DatumEndgueltigeStilllegung": "final_shutdown_date",
    "DatumBeginnVoruebergehendeStilllegung": "temporary_shutdown_start_date",
    "DatumWiederaufnahmeBetrieb": "resumption_of_operation_date",
    "EinheitBetriebsstatus": "unit_operational_status",
    "EinheitSystemstatus": "unit_system_status",
}
REGISTRY_EXTRA = {
    "wind": {"WindAnLandOderAufSee": "wind_onshore_or_offshore", "Seelage": "sea_location"},
    "solar": {
        "Einspeisungsart": "feed_in_type",
        "LokationMastrNummer": "location_id",
        "Nutzungsbereich": "usage_sector",
        "ArtDerSolaranlage": "installation_type",
    },
}
REGISTRY_SOLAR_DETAIL = {
    "EinheitMastrNummer": "unit_id",
    "Hauptausrichtung": "main_orientation",
    "HauptausrichtungNeigungswinkel": "main_orientation_tilt_bucket",
}
REGISTRY_STORAGE_LOCATION = {"EinheitMastrNummer": "unit_id", "LokationMastrNummer": "location_id"}

# Climate-database technologies and the default national solar mix.
SOLAR_TECHNOLOGIES = ["60", "61", "62", "63"]
DEFAULT_SOLAR_WEIGHTS = {"62": 0.31, "63": 0.02, "61": 0.39, "60": 0.28}
DECADES = ["1980-1989", "1990-1999", "2000-2009", "2010-2019", "2020-2025"]

# Region features kept as map context beside Germany itself.
NEIGHBOUR_COUNTRIES = ["DE", "NL", "BE", "DK", "PL", "SE", "LU"]

# Weather grid columns and the names they have in full-name source files.
GRID_RENAME = {
    "100m_u_component_of_wind": "u100",
    "100m_v_component_of_wind": "v100",
    "10m_u_component_of_wind": "u10",
    "10m_v_component_of_wind": "v10",
    "2m_temperature": "t2m",
    "surface_solar_radiation_downwards": "ssrd",
}

# Site meter columns.
METER_COLUMNS = ["Grid Meter Energy Export (kWh)", "Grid Meter Data Availability", "Energy meter based availability"]

# Turbine telemetry columns that are kept, of some 250.
SCADA_COLUMNS = ["Wind speed (m/s)", "Density adjusted wind speed (m/s)", "Power (kW)", "Data Availability"]
