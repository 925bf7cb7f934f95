"""Batch scoring and recommendations (J1–J14), DataFrame in → DataFrame out.

A scenario is a row (city, hour, day_of_week, month, weather, vehicle_type,
is_festival, is_ipl_day, surge_multiplier, hourly_ride_volume). Scoring a
million scenarios is one job: feature columns are expressions, models are
applied with ``transform`` once per model, and the 24-hour profile is an
``explode(sequence(0, 23))`` instead of 24 calls.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewise import config as C
from ridewise.functions.columns import col_, flag, lookup, round_np, season

# The scoring service's category codes (alphabetical order of the
# reference's training data).
CITY_CODES = {"Bengaluru": 0, "Chennai": 1, "Delhi NCR": 2, "Hyderabad": 3, "Mumbai": 4}
VEHICLE_CODES = {"auto": 0, "bike_taxi": 1, "economy": 2, "premium": 3, "shared": 4}
WEATHER_CODES = {"clear": 0, "fog": 1, "heavy_rain": 2, "light_rain": 3}

# Model-free rule estimates of the live predictor.
RULE_BASE_WAIT = {"clear": 7.5, "light_rain": 9.5, "heavy_rain": 14.0, "fog": 10.5}
RULE_BASE_SURGE = {"clear": 0.2, "light_rain": 0.4, "heavy_rain": 0.75, "fog": 0.45}
PROFILE_BASE_SURGE = {"clear": 0.2, "light_rain": 0.4, "heavy_rain": 0.7, "fog": 0.45}

# Recommendation texts and severity keywords.
REC_DISPATCH = "Dispatch additional drivers to %s — predicted wait %s min"
REC_SURGE = "Surge alert (%s) — pre-position fleet before %s:00"
REC_RAIN = "Heavy rain: activate rain surge protocol, expect 3× cancellations"
REC_FESTIVAL = "Festival day: deploy surge standby pool from 6 PM onwards"
REC_IPL = "Post-IPL demand spike expected — activate 150+ standby vehicles"
REC_NORMAL = "Demand is normal — maintain current fleet distribution"
ALARM_WORDS = ["urgent", "extreme", "critical", "alert", "heavy"]
WARNING_WORDS = ["surge", "high", "spike", "festival"]

WAIT_FEATURES = ["hour", "day_of_week", "month", "quarter", "is_peak_hour", "is_weekend", "is_night",
                 "is_raining", "is_heavy_rain", "is_fog", "is_festival", "is_ipl_day",
                 "surge_multiplier", "demand_pressure", "hourly_ride_volume",
                 "city_code", "vehicle_code", "weather_code", "season_code",
                 "hour_sin", "hour_cos", "dow_sin", "dow_cos"]
SURGE_FEATURES = ["hour", "day_of_week", "month", "quarter", "is_peak_hour", "is_weekend", "is_night",
                  "is_raining", "is_heavy_rain", "is_fog", "is_festival", "is_ipl_day",
                  "demand_pressure", "hourly_ride_volume", "city_code", "weather_code", "season_code",
                  "hour_sin", "hour_cos", "dow_sin", "dow_cos"]
CANCEL_FEATURES = ["hour", "day_of_week", "month", "is_peak_hour", "is_weekend", "is_night",
                   "is_raining", "is_heavy_rain", "is_fog", "is_festival", "is_ipl_day",
                   "surge_multiplier", "demand_pressure", "city_code", "vehicle_code",
                   "weather_code", "season_code"]
SCENARIO_COLUMNS = ["city", "hour", "day_of_week", "month", "weather", "vehicle_type",
                    "is_festival", "is_ipl_day", "surge_multiplier", "hourly_ride_volume"]


def _peak(h: Column) -> Column:
    return h.isin(C.PEAK_HOURS)


# J2 -------------------------------------------------------------------------------
def scenario_demand_pressure(surge="surge_multiplier", hour="hour", weather="weather",
                             festival="is_festival", ipl="is_ipl_day") -> Column:
    """surge + .5 peak + .4 rain + .6 festival + .5 ipl, round 2."""
    h, w = col_(hour), col_(weather)
    raw = (col_(surge).cast("double")
           + F.when(_peak(h), 0.5).otherwise(0.0)
           + F.when(w.isin("light_rain", "heavy_rain"), 0.4).otherwise(0.0)
           + F.when(col_(festival), 0.6).otherwise(0.0)
           + F.when(col_(ipl), 0.5).otherwise(0.0))
    return round_np(raw, 2)


# J1 -------------------------------------------------------------------------------
def with_scenario_defaults(df: DataFrame) -> DataFrame:
    """Fill optional request fields with the service defaults."""
    cols = {}
    if "surge_multiplier" not in df.columns:
        cols["surge_multiplier"] = F.lit(C.DEFAULT_SURGE)
    if "hourly_ride_volume" not in df.columns:
        cols["hourly_ride_volume"] = F.lit(float(C.DEFAULT_VOLUME))
    if "vehicle_type" not in df.columns:
        cols["vehicle_type"] = F.lit("economy")
    out = df.withColumns(cols) if cols else df
    return out.withColumns({
        "surge_multiplier": F.coalesce(F.col("surge_multiplier").cast("double"), F.lit(C.DEFAULT_SURGE)),
        "hourly_ride_volume": F.coalesce(F.col("hourly_ride_volume").cast("double"), F.lit(float(C.DEFAULT_VOLUME))),
    })


def build_scenario_features(df: DataFrame) -> DataFrame:
    """Request columns → the full model feature row (defaults for the rest)."""
    df = with_scenario_defaults(df)
    h, d, m, w = F.col("hour"), F.col("day_of_week"), F.col("month"), F.col("weather")
    two_pi = 2 * math.pi
    season_code = lookup(season(m), C.SEASON_CODES, C.UNKNOWN_SEASON_CODE)
    lags = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(C.DEFAULT_LAG))) if c in df.columns else F.lit(float(C.DEFAULT_LAG))
            for c in ("rides_lag_1d", "rides_lag_7d", "rides_roll_3d", "rides_roll_7d")}
    return df.withColumns({
        "quarter": (F.floor((m - 1) / 3) + 1).cast("int"),
        "is_peak_hour": flag(_peak(h)),
        "is_weekend": flag(d >= 5),
        "is_night": flag(h.isin(C.NIGHT_HOURS)),
        "is_raining": flag(w.isin("light_rain", "heavy_rain")),
        "is_heavy_rain": flag(w == "heavy_rain"),
        "is_fog": flag(w == "fog"),
        "is_festival_i": F.col("is_festival").cast("int"),
        "is_ipl_day_i": F.col("is_ipl_day").cast("int"),
        "demand_pressure": scenario_demand_pressure(),
        "city_code": lookup("city", CITY_CODES, C.UNKNOWN_CITY_CODE).cast("int"),
        "vehicle_code": lookup("vehicle_type", VEHICLE_CODES, C.UNKNOWN_VEHICLE_CODE).cast("int"),
        "weather_code": lookup("weather", WEATHER_CODES, C.UNKNOWN_WEATHER_CODE).cast("int"),
        "season_code": season_code.cast("int"),
        "hour_sin": F.sin(F.lit(two_pi) * h / 24.0),
        "hour_cos": F.cos(F.lit(two_pi) * h / 24.0),
        "dow_sin": F.sin(F.lit(two_pi) * d / 7.0),
        "dow_cos": F.cos(F.lit(two_pi) * d / 7.0),
        **lags,
    })


# J4 / J5 label logic ------------------------------------------------------------------
def surge_label(prob) -> Column:
    p = col_(prob)
    return (F.when(p >= 0.8, "Extreme surge risk").when(p >= 0.6, "High surge risk")
             .when(p >= 0.4, "Moderate risk").otherwise("Normal"))


def cancel_label(prob) -> Column:
    p = col_(prob)
    return F.when(p >= 0.2, "High cancellation risk").when(p >= 0.12, "Moderate risk").otherwise("Low risk")


def _positive_prob(col: str = "probability") -> Column:
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))[1]


def wait_result(pred) -> Column:
    """Minutes clipped to [0.5, 60], round 1."""
    return round_np(F.least(F.greatest(col_(pred), F.lit(0.5)), F.lit(60.0)), 1)


def surge_result(prob) -> Column:
    """struct(probability, is_high_surge, label, surge_estimate); threshold and label on the unrounded probability."""
    p = col_(prob)
    return F.struct(round_np(p, 3).alias("probability"), (p >= 0.5).alias("is_high_surge"),
                    surge_label(p).alias("label"), round_np(1.0 + p * 2.5, 2).alias("surge_estimate"))


def cancel_result(prob) -> Column:
    """struct(probability, label); label on the unrounded probability."""
    p = col_(prob)
    return F.struct(round_np(p, 3).alias("probability"), cancel_label(p).alias("label"))


# J3 -------------------------------------------------------------------------------
def predict_wait(feat: DataFrame, model=None, out: str = "wait_time_min") -> DataFrame:
    """Wait in minutes: model clipped to [0.5, 60], round 1; no model → 7.5."""
    if model is None:
        return feat.withColumn(out, F.lit(C.FALLBACK_WAIT))
    pc = model.stages[-1].getPredictionCol()
    scored = model.transform(feat)
    return scored.withColumn(out, wait_result(pc)).drop(pc, "features")


# J4 -------------------------------------------------------------------------------
def predict_surge(feat: DataFrame, model=None, out: str = "surge") -> DataFrame:
    """struct(probability, is_high_surge, label, surge_estimate); labels on the raw prob."""
    if model is None:
        return feat.withColumn(out, F.struct(
            F.lit(C.FALLBACK_SURGE_PROB).alias("probability"), F.lit(False).alias("is_high_surge"),
            F.lit("Normal").alias("label"), F.lit(None).cast("double").alias("surge_estimate")))
    pc = model.stages[-1].getPredictionCol()
    scored = model.transform(feat)
    return scored.withColumn(out, surge_result(_positive_prob())).drop(pc, "features", "rawPrediction", "probability")


# J5 -------------------------------------------------------------------------------
def predict_cancel(feat: DataFrame, model=None, out: str = "cancellation") -> DataFrame:
    if model is None:
        return feat.withColumn(out, F.struct(F.lit(C.FALLBACK_CANCEL_PROB).alias("probability"),
                                             F.lit("Low risk").alias("label")))
    pc = model.stages[-1].getPredictionCol()
    scored = model.transform(feat)
    return scored.withColumn(out, cancel_result(_positive_prob())).drop(pc, "features", "rawPrediction", "probability")


# J8 / J9 ----------------------------------------------------------------------------
def recommendations(city="city", wait="wait_time_min", high_surge="surge.is_high_surge",
                    label="surge.label", hour="hour", weather="weather",
                    festival="is_festival", ipl="is_ipl_day") -> Column:
    """Up to five advice texts in fixed order; 'demand is normal' when none apply."""
    w = col_(wait)
    wait_txt = F.rint(w).cast("long").cast("string")       # '{:.0f}' rounds half to even
    recs = F.array(
        F.when(w > 10, F.format_string(REC_DISPATCH, col_(city), wait_txt)),
        F.when(F.coalesce(col_(high_surge), F.lit(False)), F.format_string(REC_SURGE, col_(label), col_(hour).cast("string"))),
        F.when(col_(weather) == "heavy_rain", F.lit(REC_RAIN)),
        F.when(col_(festival), F.lit(REC_FESTIVAL)),
        F.when(col_(ipl) & (col_(hour) >= 21), F.lit(REC_IPL)),
    )
    kept = F.filter(recs, lambda x: x.isNotNull())
    return F.when(F.size(kept) == 0, F.array(F.lit(REC_NORMAL))).otherwise(kept)


def recommendation_severity(recs="recommendations") -> Column:
    """Per text: 'alarm' / 'warning' / 'ok' by keywords in the lower-cased text."""
    alarm = "(" + "|".join(ALARM_WORDS) + ")"
    warn = "(" + "|".join(WARNING_WORDS) + ")"
    return F.transform(col_(recs), lambda t: F.when(F.lower(t).rlike(alarm), "alarm")
                       .when(F.lower(t).rlike(warn), "warning").otherwise("ok"))


# J6 / J7 ----------------------------------------------------------------------------
def rule_based_estimates(df: DataFrame) -> DataFrame:
    """Model-free wait, surge risk, cancellation risk, pressure and two advice lines."""
    h, w = F.col("hour"), F.col("weather")
    fest, ipl = F.col("is_festival"), F.col("is_ipl_day")
    ipl_night = ipl & (h >= 21)
    wait = round_np(lookup(w, RULE_BASE_WAIT) * F.when(_peak(h), 1.3).otherwise(1.0)
                    * F.when(fest, 1.4).otherwise(1.0) * F.when(ipl_night, 1.6).otherwise(1.0), 1)
    base = (lookup(w, RULE_BASE_SURGE) + F.when(_peak(h), 0.15).otherwise(0.0)
            + F.when(fest, 0.2).otherwise(0.0) + F.when(ipl_night, 0.3).otherwise(0.0))
    prob = F.least(round_np(base, 2), F.lit(1.0))
    out = df.withColumns({"rule_wait": wait, "rule_surge_prob": prob})
    p = F.col("rule_surge_prob")
    return out.withColumns({
        "rule_surge_label": surge_label(p),
        "rule_cancel_prob": round_np(F.lit(0.04) + F.when(w == "heavy_rain", 0.12).otherwise(0.0)
                                     + F.when(p >= 0.6, 0.08).otherwise(0.0), 2),
        "rule_demand_pressure": round_np(F.lit(1.5) + p * 1.5, 2),
        "rule_surge_estimate": round_np(F.lit(1.0) + p * 2.5, 2),
        "rule_advice": F.array(
            F.when(F.col("rule_wait") > 10, F.concat(F.lit("High demand — pre-position fleet in "), F.col("city")))
             .otherwise(F.lit("Normal demand conditions")),
            F.when(p >= 0.5, F.concat(F.lit("Surge alert: "), surge_label(p), F.lit(" — activate standby pool")))
             .otherwise(F.lit("No surge action needed"))),
    })


def rule_based_profile(scenarios: DataFrame) -> DataFrame:
    """24-hour model-free profile per scenario (the live page's variant)."""
    prof = scenarios.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    h, w, fest = F.col("hour"), F.col("weather"), F.col("is_festival")
    pm = F.when(_peak(h), 1.3).when(h.isin(C.DEAD_HOURS), 0.8).otherwise(1.0)
    sp = F.least(lookup(w, PROFILE_BASE_SURGE) + F.when(_peak(h), 0.15).otherwise(0.0)
                 + F.when(fest, 0.2).otherwise(0.0), F.lit(1.0))
    return prof.withColumns({
        "wait_time_min": round_np(lookup(w, RULE_BASE_WAIT) * pm * F.when(fest, 1.4).otherwise(1.0), 1),
        "surge_risk_pct": round_np(sp * 100, 1),
    })


# J10 --------------------------------------------------------------------------------
def traffic_light(x, red: float, amber: float) -> Column:
    """red when x ≥ red, amber when x ≥ amber, else green."""
    v = col_(x)
    return F.when(v >= red, "red").when(v >= amber, "amber").otherwise("green")


def gauge_zone(x, lo: float, hi: float) -> Column:
    """green below lo, amber below hi, red from hi on."""
    v = col_(x)
    return F.when(v < lo, "green").when(v < hi, "amber").otherwise("red")


def status_lights(df: DataFrame, prob="rule_surge_prob", wait="rule_wait",
                  pressure="rule_demand_pressure") -> DataFrame:
    return df.withColumns({
        "surge_light": traffic_light(prob, 0.7, 0.4),
        "wait_light": traffic_light(wait, 12, 8),
        "wait_gauge": gauge_zone(wait, 6, 10),
        "surge_gauge": gauge_zone(col_(prob) * 100, 40, 65),
        "pressure_gauge": gauge_zone(pressure, 2, 3),
    })


# J14 --------------------------------------------------------------------------------
def predict_demand(requests: DataFrame, models: dict, out: str = "predicted_rides") -> DataFrame:
    """Rides for each request from its city's model, never below 0; a city without model gives null.

    Requests take the service defaults (lags and rolling means of 15 where not
    given). The feature vector is built once, in one scan for all cities. Each
    prediction is named once, within its city's branch, so Spark moves it there
    and a row is scored by its own city's trees alone.
    """
    feat = build_scenario_features(requests)
    if not models:
        return feat.withColumn(out, F.lit(None).cast("double"))
    names = sorted(models)
    scored, columns = models[names[0]].stages[0].transform(feat), {}
    for i, city in enumerate(names):
        trees = models[city].stages[-1]
        columns[city] = f"_rides_{i}"
        scored = trees.copy({trees.predictionCol: columns[city]}).transform(scored)
    pick = F
    for city in names:
        pick = pick.when(F.col("city") == city, F.greatest(F.col(columns[city]), F.lit(0.0)))
    kept = [c for c in feat.columns]
    return scored.select(*kept, pick.alias(out))


# J11 / J12 --------------------------------------------------------------------------
def predict_all(scenarios: DataFrame, wait_model=None, surge_model=None, cancel_model=None) -> DataFrame:
    """One nested result row per scenario (models optional → service fallbacks).

    Output: the scenario's own columns, then wait_time_min, surge struct,
    cancellation struct, demand_pressure and the recommendation list.
    """
    feat = build_scenario_features(scenarios)
    scored = predict_cancel(predict_surge(predict_wait(feat, wait_model), surge_model), cancel_model)
    own = [c for c in with_scenario_defaults(scenarios).columns]
    return scored.select(*own, "wait_time_min", "surge", "cancellation", "demand_pressure",
                         recommendations().alias("recommendations"))


def hourly_profile(scenarios: DataFrame, wait_model=None, surge_model=None, cancel_model=None) -> DataFrame:
    """24 rows per scenario, scored in one pass (hour exploded, not looped)."""
    base = scenarios.drop("hour").withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    res = predict_all(base, wait_model, surge_model, cancel_model)
    keep = [c for c in base.columns if c != "hour"]
    return res.select(*keep, "hour", "wait_time_min",
                      F.col("surge.probability").alias("surge_prob"), F.col("surge.label").alias("surge_label"),
                      F.col("cancellation.probability").alias("cancel_prob"), "demand_pressure")


def scenarios_from_rides(enriched: DataFrame) -> DataFrame:
    """Scenario requests as recorded by rides (one per ride)."""
    return enriched.select(F.col("ride_id").alias("scenario_id"), *[
        F.col(c).cast("double").alias(c) if c in ("surge_multiplier", "hourly_ride_volume") else F.col(c)
        for c in SCENARIO_COLUMNS])


def scenario_keys(enriched: DataFrame) -> DataFrame:
    """Distinct (city, month, day_of_week, weather, festival, ipl) day scenarios."""
    return enriched.select("city", "month", "day_of_week", "weather", "is_festival", "is_ipl_day").distinct()
