"""Report queries over the published marts."""

from pyspark.sql import functions as F

from tablemart.operators.ranking import all_at_extreme, extremes, top_rows


def in_dates(frame, first, last, column="trip_date"):
    """Rows from the first to the last date, both included; prunes date partitions."""
    return frame.filter(F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def by_date(frame, *more):
    return frame.orderBy("trip_date", *more)


def kpis(daily):
    """Trips, revenue and revenue per trip (0 without trips)."""
    totals = daily.agg(
        F.coalesce(F.sum("trips"), F.lit(0)).alias("trips"),
        F.coalesce(F.sum("revenue_usd"), F.lit(0)).alias("revenue_usd"),
    )
    return totals.withColumn(
        "average_trip_usd",
        F.coalesce(F.try_divide(F.col("revenue_usd").cast("double"), F.col("trips")), F.lit(0.0)),
    )


def trips_by(mart, column):
    return mart.groupBy(column).agg(F.sum("trips").alias("trips"))


def metric_totals(enriched):
    """Distinct trips and reported revenue."""
    return enriched.agg(
        F.countDistinct("trip_id").alias("total_trips"),
        F.sum("trip_total_usd").alias("reported_revenue"),
    )


def distance_range(distances):
    """Longest and shortest positive distance in one pass."""
    km = F.col("trip_distance_km")
    return distances.agg(
        F.max(km).alias("longest_km"), F.min(F.when(km > 0, km)).alias("shortest_positive_km")
    )


def activity_only(area_demand, activity):
    """One activity; both together would count each trip twice."""
    return area_demand.filter(F.col("activity") == activity)


def area_trips(area_demand, activity):
    return activity_only(area_demand, activity).groupBy("area_id", "area_name").agg(
        F.sum("trips").alias("trips")
    )


def top_taxis(revenue, first, last, count):
    """Vehicles with the highest reported total; ranked after the date filter."""
    per_taxi = in_dates(revenue, first, last).groupBy("taxi_key", "taxi_label").agg(
        F.sum("trips").alias("trips"), F.sum("reported_total_usd").alias("reported_total_usd")
    )
    return top_rows(per_taxi, [F.desc("reported_total_usd"), F.asc("taxi_key")], count)


def extreme_trips(distances):
    """The longest trips and the shortest positive ones, all ties, with which of both they are."""
    return extremes(distances, "trip_distance_km", F.col("is_positive_distance"))


def longest_trips(distances):
    return all_at_extreme(distances, "trip_distance_km", F.max)


def shortest_trips(distances):
    """Shortest positive trips, all ties."""
    return all_at_extreme(distances, "trip_distance_km", F.min, F.col("is_positive_distance"))


def rain_compare(weather_demand):
    """Average trips per observed hour by condition, with the number of hours.

    The mart has one row per hour and condition, so its rows are the hours.
    """
    return weather_demand.groupBy("weather_condition").agg(
        F.count("*").alias("hours"),
        F.sum("trips").alias("trips"),
    ).withColumn("trips_per_hour", F.col("trips") / F.col("hours"))


def area_flows(enriched, count):
    """Busiest pickup -> dropoff pairs."""
    pairs = enriched.groupBy("pickup_area_name", "dropoff_area_name").agg(
        F.count("*").alias("trips"), F.sum("trip_total_usd").alias("reported_total_usd")
    )
    return top_rows(
        pairs, [F.desc("trips"), F.asc("pickup_area_name"), F.asc("dropoff_area_name")], count
    )


def temperature_coverage(enriched):
    """Demand per hour with its temperature, and how many trips lack weather."""
    return enriched.groupBy("trip_date", "trip_hour").agg(
        F.max("temperature_c").alias("temperature_c"),
        F.count("*").alias("trips"),
        F.count_if("weather_available").alias("trips_with_weather"),
        F.count_if(~F.col("weather_available")).alias("trips_without_weather"),
    )
