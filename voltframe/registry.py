"""S8 raw table catalogue: the 30 survey tables and their declared types.

Each entry is ``schema.table`` followed by its survey columns in declared
order.  Suffix ``:B`` is BIGINT, ``:N`` is NUMERIC(18,6), ``:L`` is BOOLEAN,
no suffix is VARCHAR.  Every table also carries the three lineage columns
``file_year`` INT NOT NULL, ``file_date`` TIMESTAMP NOT NULL and
``upload_timestamp`` TIMESTAMP NOT NULL, appended after the survey columns.

Column names are cut to 63 characters (T2) when the StructType is built, so
the one 70-character name below is stored in its 63-character form.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import types as T

from voltframe.functions.names import truncate_name

# ---------------------------------------------------------------------------
# The catalogue of the survey releases (table, columns, types).
# ---------------------------------------------------------------------------
TABLE_SPEC = """
energystorage.operable:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, status, technology, prime_mover, sector_name, sector:B,
    nameplate_capacity_mw:N, summer_capacity_mw:N, winter_capacity_mw:N,
    operating_month:B, operating_year:B, nameplate_energy_capacity_mwh,
    maximum_charge_rate_mw, maximum_discharge_rate_mw, storage_technology_1,
    storage_technology_2, storage_technology_3, storage_technology_4,
    nameplate_reactive_power_rating, storage_enclosure_type, arbitrage,
    frequency_regulation, load_following, ramping_spinning_reserve,
    colocated_renewable_firming, transmission_and_distribution_deferral,
    system_peak_shaving, load_management, voltage_or_reactive_power_support,
    backup_power, excess_wind_and_solar_generation, ac_coupled, dc_coupled,
    dc_tightly_coupled, independent, direct_support_of_another_unit,
    direct_support_plant_id_1, direct_support_gen_id_1,
    direct_support_plant_id_2, direct_support_gen_id_2,
    direct_support_plant_id_3, direct_support_gen_id_3, support_td_asset
energystorage.proposed:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, status, technology, prime_mover, sector_name, sector:B,
    nameplate_capacity_mw:N, summer_capacity_mw:N, winter_capacity_mw:N,
    current_month:B, current_year:B, nameplate_energy_capacity_mwh,
    maximum_charge_rate_mw, maximum_discharge_rate_mw, storage_technology_1,
    storage_technology_2, storage_technology_3, storage_technology_4,
    nameplate_reactive_power_rating, storage_enclosure_type, arbitrage,
    frequency_regulation, load_following, ramping_spinning_reserve,
    colocated_renewable_firming, transmission_and_distribution_deferral,
    system_peak_shaving, load_management, voltage_or_reactive_power_support,
    backup_power, excess_wind_and_solar_generation, ac_coupled, dc_coupled,
    dc_tightly_coupled:L, independent, direct_support_of_another_unit,
    direct_support_plant_id_1, direct_support_gen_id_1,
    direct_support_plant_id_2, direct_support_gen_id_2,
    direct_support_plant_id_3, direct_support_gen_id_3, support_td_asset
energystorage.retired_and_canceled:
    utility_id, utility_name, plant_code:B, plant_name, state, county,
    generator_id, status, technology, prime_mover, sector_name, sector,
    nameplate_capacity_mw:N, summer_capacity_mw, winter_capacity_mw,
    operating_month, operating_year, retirement_month, retirement_year,
    nameplate_energy_capacity_mwh, maximum_charge_rate_mw,
    maximum_discharge_rate_mw, storage_technology_1, storage_technology_2,
    storage_technology_3, storage_technology_4,
    nameplate_reactive_power_rating, storage_enclosure_type, arbitrage,
    frequency_regulation, load_following, ramping_spinning_reserve,
    colocated_renewable_firming, transmission_and_distribution_deferral,
    system_peak_shaving, load_management, voltage_or_reactive_power_support,
    backup_power, excess_wind_and_solar_generation, ac_coupled, dc_coupled,
    dc_tightly_coupled, independent, direct_support_of_another_unit,
    direct_support_plant_id_1, direct_support_gen_id_1,
    direct_support_plant_id_2, direct_support_gen_id_2,
    direct_support_plant_id_3, direct_support_gen_id_3, support_td_asset
enviroassoc.boiler_cooling:
    utility_id:B, utility_name, plant_code:B, plant_name, boiler_id,
    cooling_id, steam_plant_type:B
enviroassoc.boiler_generator:
    utility_id:B, utility_name, plant_code:B, plant_name, boiler_id,
    generator_id, steam_plant_type:B
enviroassoc.boiler_mercury:
    utility_id:B, utility_name, plant_code:B, plant_name, boiler_id,
    mercury_control_id, steam_plant_type:B
enviroassoc.boiler_nox:
    utility_id:B, utility_name, plant_code:B, plant_name, boiler_id,
    nox_control_id, steam_plant_type:B
enviroassoc.boiler_particulate_matter:
    utility_id:B, utility_name, plant_code:B, plant_name, boiler_id,
    particulate_matter_control_id, steam_plant_type:B
enviroassoc.boiler_so2:
    utility_id:B, utility_name, plant_code:B, plant_name, boiler_id,
    so2_control_id, steam_plant_type:B
enviroassoc.boiler_stack_flue:
    utility_id:B, utility_name, plant_code:B, plant_name, boiler_id,
    stack_flue_id, steam_plant_type:B
enviroassoc.emissions_control_equipment:
    utility_id:B, utility_name, plant_code:B, plant_name, equipment_type,
    particulate_matter_control_id, so2_control_id, nox_control_id,
    mercury_control_id, acid_gas_control:L, status, inservice_month,
    inservice_year, retirement_month, retirement_year,
    total_cost_thousand_dollars, steam_plant_type:B
enviroequip.boiler_info_design_parameters:
    utility_id:B, utility_name, plant_code:B, plant_name, state, boiler_id,
    hrsg, boiler_status, type_of_boiler, inservice_month, inservice_year,
    retirement_month, retirement_year, firing_type_1, firing_type_2,
    firing_type_3, max_steam_flow_thousand_pounds_per_hour,
    firing_rate_using_coal_01_tons_per_hour,
    firing_rate_using_petroleum_01_barrels_per_hour,
    firing_rate_using_gas_01_mcf_per_hour, firing_rate_using_other_fuels,
    waste_heat_input_million_btu_per_hour, primary_fuel_1, primary_fuel_2,
    primary_fuel_3, primary_fuel_4, turndown_ratio, efficiency_100_load,
    efficiency_50_load, air_flow_100_load_cubic_feet_per_minute,
    wet_dry_bottom, fly_ash_reinjection, steam_plant_type:B
enviroequip.cooling:
    utility_id:B, utility_name, plant_code:B, plant_name, state, cooling_id,
    cooling_status, inservice_month:B, inservice_year:B, cooling_type_1,
    cooling_type_2, cooling_type_3:L, cooling_type_4, percent_dry_cooling,
    cooling_water_source, cooling_water_discharge, water_source_code,
    water_type_code, intake_rate_at_100_gallons_per_minute,
    chlorine_inservice_month, chlorine_inservice_year, pond_inservice_month,
    pond_inservice_year, pond_surface_area_acres, pond_volume_acre_feet,
    tower_inservice_month, tower_inservice_year, tower_type_1, tower_type_2,
    tower_type_3, tower_type_4, tower_water_rate_gallons_per_minute,
    power_requirement_mw, cost_total_thousand_dollars,
    cost_ponds_thousand_dollars, cost_towers_thousand_dollars,
    cost_chlorine_equipment_thousand_dollars, intake_distance_shore_feet,
    outlet_distance_shore_feet, intake_distance_surface_feet,
    outlet_distance_surface_feet, steam_plant_type:B
enviroequip.emission_standards_strategies:
    utility_id:B, utility_name, plant_code:B, plant_name, state, boiler_id,
    boiler_status, type_of_boiler, new_source_review,
    new_source_review_permit, new_source_review_month,
    new_source_review_year, regulation_sulfur, standard_sulfur_rate,
    standard_sulfur_percent_scrubbed, unit_sulfur, period_sulfur,
    compliance_year_sulfur, sulfur_dioxide_control_existing_strategy_1,
    sulfur_dioxide_control_existing_strategy_2,
    sulfur_dioxide_control_existing_strategy_3,
    sulfur_dioxide_control_proposed_strategy_1,
    sulfur_dioxide_control_proposed_strategy_2,
    sulfur_dioxide_control_proposed_strategy_3, regulation_nitrogen,
    standard_nitrogen_rate, unit_nitrogen, period_nitrogen,
    compliance_year_nitrogen, nitrogen_oxide_control_existing_strategy_1,
    nitrogen_oxide_control_existing_strategy_2,
    nitrogen_oxide_control_existing_strategy_3,
    nitrogen_oxide_control_proposed_strategy_1,
    nitrogen_oxide_control_proposed_strategy_2,
    nitrogen_oxide_control_proposed_strategy_3, regulation_particulate,
    standard_particulate_rate, unit_particulate, period_particulate,
    compliance_year_particulate, regulation_mercury,
    compliance_year_mercury, mercury_control_existing_strategy_1,
    mercury_control_existing_strategy_2,
    mercury_control_existing_strategy_3,
    mercury_control_proposed_strategy_1,
    mercury_control_proposed_strategy_2,
    mercury_control_proposed_strategy_3, steam_plant_type:B
enviroequip.fgd:
    utility_id:B, utility_name, plant_code:B, plant_name, state,
    so2_control_id, so2_type_1, so2_type_2, so2_type_3, so2_type_4,
    sorbent_type_1, sorbent_type_2, sorbent_type_3, sorbent_type_4:L,
    byproduct_recovery, pond_landfill_requirements_acre_foot_per_year:N,
    sludge_pond, sludge_pond_lined, flue_gas_bypass_fgd,
    specifications_of_coal_ash, specifications_of_coal_sulfur,
    fgd_trains_total, fgd_trains_100, removal_efficiency_of_sulfur,
    sulfur_emission_rate_pounds_per_hour,
    flue_gas_exit_rate_cubic_feet_per_minute,
    flue_gas_exit_temperature_fahrenheit,
    flue_gas_entering_fgd_percent_of_total, cost_structure_thousand_dollars,
    cost_disposal_thousand_dollars, cost_other_thousand_dollars,
    cost_total_thousand_dollars, steam_plant_type:B
enviroequip.fgp:
    utility_id:B, utility_name, plant_code:B, plant_name, state,
    particulate_matter_control_id, collector_type_1, collector_type_2,
    collector_type_3, fuel_specification_ash_coal,
    fuel_specification_ash_petroleum, fuel_specification_sulfur_coal,
    fuel_specification_sulfur_petroleum, collection_efficiency,
    emission_rate_pounds_per_hour, gas_exit_rate_cubic_feet_per_minute,
    gas_exit_temperature_fahrenheit, steam_plant_type:B
enviroequip.stack_flue:
    utility_id:B, utility_name, plant_code:B, plant_name, state,
    stack_or_flue_id, inservice_month, inservice_year, stack_flue_status,
    stack_height_feet, area_at_top_square_feet,
    exit_rate_100_cubic_feet_per_minute, exit_rate_50_cubic_feet_per_minute,
    exit_temperature_100_fahrenheit, exit_temperature_50_fahrenheit,
    exit_velocity_100_feet_per_second, exit_velocity_50_feet_per_second,
    exit_temperature_summer_fahrenheit, exit_temperature_winter_fahrenheit,
    exit_temperature_measured_or_estimated, steam_plant_type:B
generator.operable:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, technology, prime_mover, unit_code, ownership,
    duct_burners, can_bypass_heat_recovery_steam_generator,
    rtoiso_lmp_node_designation,
    rtoiso_location_designation_for_reporting_wholesale_sales_data_to_ferc,
    nameplate_capacity_mw:N, nameplate_power_factor:N, summer_capacity_mw:N,
    winter_capacity_mw:N, minimum_load_mw,
    uprate_or_derate_completed_during_year,
    month_uprate_or_derate_completed, year_uprate_or_derate_completed,
    status, synchronized_to_transmission_grid, operating_month:B,
    operating_year:B, planned_retirement_month, planned_retirement_year,
    associated_with_combined_heat_and_power_system, sector_name, sector:B,
    topping_or_bottoming, energy_source_1, energy_source_2, energy_source_3,
    energy_source_4, energy_source_5, energy_source_6, startup_source_1,
    startup_source_2, startup_source_3, startup_source_4,
    solid_fuel_gasification_system, carbon_capture_technology,
    turbines_or_hydrokinetic_buoys, time_from_cold_shutdown_to_full_load,
    fluidized_bed_technology, pulverized_coal_technology, stoker_technology,
    other_combustion_technology, subcritical_technology,
    supercritical_technology, ultrasupercritical_technology,
    planned_net_summer_capacity_uprate_mw,
    planned_net_winter_capacity_uprate_mw, planned_uprate_month,
    planned_uprate_year, planned_net_summer_capacity_derate_mw,
    planned_net_winter_capacity_derate_mw, planned_derate_month,
    planned_derate_year, planned_new_prime_mover, planned_energy_source_1,
    planned_new_nameplate_capacity_mw, planned_repower_month,
    planned_repower_year, other_planned_modifications,
    other_modifications_month, other_modifications_year, multiple_fuels,
    cofire_fuels, switch_between_oil_and_natural_gas
generator.proposed:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, technology, prime_mover, unit_code, ownership,
    duct_burners, can_bypass_heat_recovery_steam_generator,
    rtoiso_lmp_node_designation,
    rtoiso_location_designation_for_reporting_wholesale_sales_data_to_ferc,
    nameplate_capacity_mw:N, nameplate_power_factor, summer_capacity_mw:N,
    winter_capacity_mw, status, effective_month:B, effective_year:B,
    current_month:B, current_year:B,
    associated_with_combined_heat_and_power_system, sector_name, sector:B,
    previously_canceled, energy_source_1, energy_source_2, energy_source_3,
    energy_source_4, energy_source_5, energy_source_6,
    turbines_or_hydrokinetic_buoys, fluidized_bed_technology,
    pulverized_coal_technology, stoker_technology:L,
    other_combustion_technology, subcritical_technology,
    supercritical_technology, ultrasupercritical_technology,
    solid_fuel_gasification_system, carbon_capture_technology,
    multiple_fuels, switch_between_oil_and_natural_gas, cofire_fuels
generator.retired_and_canceled:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, technology, prime_mover, unit_code, ownership,
    duct_burners, can_bypass_heat_recovery_steam_generator,
    rtoiso_lmp_node_designation,
    rtoiso_location_designation_for_reporting_wholesale_sales_data_to_ferc,
    nameplate_capacity_mw:N, nameplate_power_factor, summer_capacity_mw:N,
    winter_capacity_mw:N, minimum_load_mw,
    uprate_or_derate_completed_during_year,
    month_uprate_or_derate_completed, year_uprate_or_derate_completed,
    status, synchronized_to_transmission_grid, operating_month,
    operating_year, retirement_month, retirement_year,
    associated_with_combined_heat_and_power_system, sector_name, sector:B,
    topping_or_bottoming, energy_source_1, energy_source_2, energy_source_3,
    energy_source_4, energy_source_5, energy_source_6, startup_source_1,
    startup_source_2, startup_source_3, startup_source_4,
    solid_fuel_gasification_system, carbon_capture_technology,
    turbines_or_hydrokinetic_buoys, time_from_cold_shutdown_to_full_load,
    fluidized_bed_technology, pulverized_coal_technology, stoker_technology,
    other_combustion_technology, subcritical_technology,
    supercritical_technology, ultrasupercritical_technology:L,
    multiple_fuels, cofire_fuels, switch_between_oil_and_natural_gas
multifuel.operable:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, status, technology, prime_mover, sector_name, sector:B,
    nameplate_capacity_mw:N, summer_capacity_mw:N, winter_capacity_mw:N,
    operating_month:B, operating_year:B, energy_source_1, energy_source_2,
    multiple_fuels, cofire_fuels, cofire_energy_source_1,
    cofire_energy_source_2, cofire_energy_source_3, cofire_energy_source_4,
    cofire_energy_source_5, cofire_energy_source_6,
    switch_between_oil_and_natural_gas, switch_when_operating,
    net_summer_capacity_with_natural_gas_mw,
    net_winter_capacity_with_natural_gas_mw,
    net_summer_capacity_with_oil_mw, net_winter_capacity_with_oil_mw,
    time_to_switch_from_gas_to_oil, time_to_switch_from_oil_to_gas,
    factors_that_limit_switching, storage_limits:L, air_permit_limits:L,
    other_limits:L
multifuel.proposed:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, status, technology, prime_mover, sector_name, sector:B,
    nameplate_capacity_mw:N, summer_capacity_mw:N, winter_capacity_mw,
    current_month:B, current_year:B, energy_source_1, energy_source_2,
    multiple_fuels, cofire_fuels, cofire_energy_source_1,
    cofire_energy_source_2, cofire_energy_source_3, cofire_energy_source_4,
    cofire_energy_source_5, cofire_energy_source_6,
    switch_between_oil_and_natural_gas
multifuel.retired_and_canceled:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, status, technology, prime_mover, sector_name, sector:B,
    nameplate_capacity_mw:N, summer_capacity_mw, winter_capacity_mw,
    operating_month:B, operating_year:B, retirement_month:B,
    retirement_year:B, energy_source_1, energy_source_2, multiple_fuels,
    cofire_fuels, cofire_energy_source_1, cofire_energy_source_2,
    cofire_energy_source_3, cofire_energy_source_4, cofire_energy_source_5,
    cofire_energy_source_6, switch_between_oil_and_natural_gas,
    switch_when_operating, net_summer_capacity_with_natural_gas_mw,
    net_winter_capacity_with_natural_gas_mw,
    net_summer_capacity_with_oil_mw, net_winter_capacity_with_oil_mw,
    time_to_switch_from_gas_to_oil, time_to_switch_from_oil_to_gas,
    factors_that_limit_switching, storage_limits:L, air_permit_limits:L,
    other_limits:L
owner.ownership:
    utility_id:B, utility_name, plant_code:B, plant_name, state,
    generator_id, status, owner_name, owner_street_address, owner_city,
    owner_state, owner_zip:B, ownership_id:B, percent_owned:N
plant.plant:
    utility_id:B, utility_name, plant_code:B, plant_name, street_address,
    city, state, zip:B, county, latitude:N, longitude:N, nerc_region,
    balancing_authority_code, balancing_authority_name,
    name_of_water_source, primary_purpose_naics_code:B, regulatory_status:L,
    sector:B, sector_name, ferc_cogeneration_status,
    ferc_cogeneration_docket_number, ferc_small_power_producer_status,
    ferc_small_power_producer_docket_number,
    ferc_exempt_wholesale_generator_status,
    ferc_exempt_wholesale_generator_docket_number, ash_impoundment,
    ash_impoundment_lined, ash_impoundment_status,
    transmission_or_distribution_system_owner,
    transmission_or_distribution_system_owner_id,
    transmission_or_distribution_system_owner_state, grid_voltage_kv,
    grid_voltage_2_kv, grid_voltage_3_kv, energy_storage,
    natural_gas_ldc_name, natural_gas_pipeline_name_1,
    natural_gas_pipeline_name_2, natural_gas_pipeline_name_3,
    pipeline_notes, natural_gas_storage, liquefied_natural_gas_storage
solar.operable:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, status, technology, prime_mover, sector_name, sector:B,
    nameplate_capacity_mw:N, summer_capacity_mw:N, winter_capacity_mw:N,
    operating_month:B, operating_year:B, lenses_mirrors,
    singleaxis_tracking, dualaxis_tracking, fixed_tilt, bifacial,
    east_west_fixed_tilt, parabolic_trough, linear_fresnel:L, power_tower,
    dish_engine:L, other_solar_technology, azimuth_angle, tilt_angle,
    dc_net_capacity_mw, crystalline_silicon, thinfilm_cdte, thinfilm_asi,
    thinfilm_cigs, thinfilm_other, other_materials, net_metering_agreement,
    net_metering_dc_capacity_mw, virtual_net_metering_agreement,
    virtual_net_metering_dc_capacity_mw
solar.retired_and_canceled:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, status, technology:L, prime_mover, sector_name, sector:B,
    nameplate_capacity_mw:N, summer_capacity_mw:N, winter_capacity_mw,
    operating_month, operating_year, retirement_month, retirement_year,
    lenses_mirrors:L, singleaxis_tracking, dualaxis_tracking, fixed_tilt,
    bifacial, east_west_fixed_tilt, parabolic_trough, linear_fresnel:L,
    power_tower, dish_engine, other_solar_technology, azimuth_angle,
    tilt_angle, dc_net_capacity_mw, crystalline_silicon, thinfilm_cdte:L,
    thinfilm_asi, thinfilm_cigs, thinfilm_other, other_materials:L,
    net_metering_agreement, net_metering_dc_capacity_mw,
    virtual_net_metering_agreement, virtual_net_metering_dc_capacity_mw
utility.utility:
    utility_id:B, utility_name, street_address, city, state, zip:B,
    owner_of_plants_reported_on_form:L,
    operator_of_plants_reported_on_form:L,
    asset_manager_of_plants_reported_on_form:L,
    other_relationships_with_plants_reported_on_form:L, entity_type
wind.operable:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, status, technology:L, prime_mover:L, sector_name,
    sector:B, nameplate_capacity_mw:N, summer_capacity_mw:N,
    winter_capacity_mw:N, operating_month:B, operating_year:B,
    number_of_turbines:B, predominant_turbine_manufacturer,
    predominant_turbine_model_number, design_wind_speed_mph:N,
    wind_quality_class:B, turbine_hub_height_feet:N
wind.retired_and_canceled:
    utility_id:B, utility_name, plant_code:B, plant_name, state, county,
    generator_id, status, technology, prime_mover, sector_name, sector:B,
    nameplate_capacity_mw:N, summer_capacity_mw, winter_capacity_mw,
    operating_month, operating_year, retirement_month, retirement_year,
    number_of_turbines, predominant_turbine_manufacturer,
    predominant_turbine_model_number, design_wind_speed_mph,
    wind_quality_class, turbine_hub_height_feet
"""

# Energy-source code lists used by the analytical views.
BIOMASS_CODES = ("AB", "MSW", "OBS", "WDS", "OBL", "SLW", "BLQ", "WDL", "LFG", "OBG")
RENEWABLE_CODES = ("SUN", "WND", "WAT", "GEO", "BIO", "WAS", "MSW")
FOSSIL_CODES = ("COL", "BIT", "SUB", "LIG", "NG", "DFO", "RFO", "OIL", "PC", "NGO",
                "BFG", "OG", "KER", "JF", "PG", "SGC")

# Survey releases and the years each table is published in.
SURVEY_YEARS = (2019, 2020, 2021, 2022, 2023, 2024)
PARTIAL_TABLE_YEARS = {"energystorage.proposed": (2023, 2024)}

DECIMAL_MW = T.DecimalType(18, 6)
_SUFFIX_TYPES = {
    "B": T.LongType(),
    "N": DECIMAL_MW,
    "L": T.BooleanType(),
    "": T.StringType(),
}
TYPE_NAMES = {
    "Int64": T.LongType(),
    "Float64": DECIMAL_MW,
    "Boolean": T.BooleanType(),
    "String": T.StringType(),
}

LINEAGE_FIELDS = (
    T.StructField("file_year", T.IntegerType(), nullable=False),
    T.StructField("file_date", T.TimestampNTZType(), nullable=False),
    T.StructField("upload_timestamp", T.TimestampNTZType(), nullable=False),
)
LINEAGE_COLUMNS = tuple(f.name for f in LINEAGE_FIELDS)


def _parse_spec(text: str) -> dict[str, list[tuple[str, str]]]:
    tables: dict[str, list[tuple[str, str]]] = {}
    current = None
    chunks: list[str] = []
    for line in text.strip().splitlines():
        if not line.startswith(" "):
            if current:
                tables[current] = _columns(" ".join(chunks))
            current, chunks = line.rstrip(":"), []
        else:
            chunks.append(line.strip())
    if current:
        tables[current] = _columns(" ".join(chunks))
    return tables


def _columns(joined: str) -> list[tuple[str, str]]:
    cols = []
    for item in joined.split(","):
        name, _, suffix = item.strip().partition(":")
        cols.append((truncate_name(name), suffix))
    return cols


@lru_cache(maxsize=1)
def catalogue() -> dict[str, list[tuple[str, str]]]:
    return _parse_spec(TABLE_SPEC)


def table_names() -> list[str]:
    return list(catalogue())


def survey_schema(table: str) -> T.StructType:
    """Survey columns only (no lineage), in declared order."""
    return T.StructType(
        [T.StructField(n, _SUFFIX_TYPES[s], True) for n, s in catalogue()[table]]
    )


def schema(table: str) -> T.StructType:
    """Full raw-table schema: survey columns then the lineage columns."""
    return T.StructType(survey_schema(table).fields + list(LINEAGE_FIELDS))


def schema_ddl(table: str) -> str:
    return schema(table).toDDL()


def boolean_columns(table: str) -> list[str]:
    return [n for n, s in catalogue()[table] if s == "L"]
