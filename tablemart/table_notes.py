"""What the published tables and their columns mean, for manifests and catalogs."""

OWNER = "trip analytics"

TABLES = {
    "bronze.taxi_trip_raw": "Newest raw trip record per trip, as the source sent it",
    "bronze.community_area_raw": "Newest raw community area per number",
    "bronze.weather_hour_raw": "Newest raw weather reading per hour",
    "silver.fact_taxi_trip": "Accepted trips with typed values and dimension keys",
    "silver.quarantine_taxi_trip": "Trips that broke a rule, with the first reason",
    "silver.dim_taxi": "Taxis seen in accepted trips",
    "silver.dim_payment": "Ways of payment seen in accepted trips",
    "silver.dim_company": "Companies seen in accepted trips",
    "silver.dim_area": "Pickup and dropoff areas seen in accepted trips",
    "silver.dim_date": "Days with accepted trips",
    "silver.dim_community_area": "Names and shapes of community areas",
    "silver.dim_weather_hour": "Weather per local hour",
    "gold.mart_taxi_demand_daily": "Trips, revenue and averages per day",
    "gold.mart_taxi_demand_hourly": "Trips and revenue per day and hour",
    "gold.mart_payment_demand_daily": "Trips and revenue per day and way of payment",
    "gold.mart_taxi_revenue_daily": "Trips and reported totals per day and taxi",
    "gold.mart_taxi_trip_distance": "Distance of each accepted trip",
    "gold.mart_taxi_trip_enriched": "Accepted trips with area names and the weather of their hour",
    "gold.mart_community_area_demand_daily": "Pickups and dropoffs per day and community area",
    "gold.mart_weather_demand_hourly": "Trips per day, hour and weather condition",
}

#: A column means the same in every table that has it.
COLUMNS = {
    "activity": "Pickup or Dropoff",
    "area": "Area number as the trip names it",
    "area_id": "Number of the community area",
    "area_name": "Name of the community area",
    "average_distance_km": "Mean distance in kilometres",
    "average_trip_duration_seconds": "Mean duration in seconds",
    "average_trip_usd": "Mean total of a trip in US dollars",
    "day_of_week": "Day of the week, Sunday is 1",
    "fare_usd": "Fare in US dollars",
    "geometry_geojson": "Shape of the area as GeoJSON text",
    "ingested_at_utc": "When the record was taken in, UTC",
    "is_positive_distance": "Whether the distance is above zero",
    "payload": "The record as JSON text",
    "precipitation_mm": "Precipitation of the hour in millimetres",
    "record_id": "Identity of the record at its source",
    "rejection_reason": "First rule that the trip broke",
    "reported_total_usd": "Sum of reported totals in US dollars",
    "revenue_usd": "Sum of trip totals in US dollars",
    "run_id": "Run that took the record in",
    "sequence": "Place of the record among all that were taken in",
    "snowfall_cm": "Snowfall of the hour in centimetres",
    "source_hours": "Readings that make up the local hour",
    "started_at": "Local start of the trip",
    "temperature_c": "Air temperature in degrees Celsius",
    "tips_usd": "Tips in US dollars",
    "trip_date": "Local day on which the trip started",
    "trip_distance_km": "Distance in kilometres",
    "trip_distance_miles": "Distance in miles, as reported",
    "trip_duration_seconds": "Duration in seconds",
    "trip_hour": "Local hour in which the trip started",
    "trip_total_usd": "Total of the trip in US dollars",
    "trips": "Number of trips",
    "weather_ambiguous": "Whether the local hour occurs twice on that day",
    "weather_available": "Whether there is a reading for the hour",
    "weather_condition": "Condition of the hour, from its readings",
    "weather_local_hour": "Local hour of the weather reading",
}


def describe(table):
    """Meaning of a table; its own name where nothing is noted."""
    return TABLES.get(table, table)


def describe_column(name):
    """Meaning of a column; its own name where nothing is noted."""
    return COLUMNS.get(name, name)
