"""End-to-end flows composed from kiln operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions import scalar as X
from kiln.operators import schema as S
from kiln.operators import stats as ST
from kiln.operators import validate as V
from kiln.operators.analyze import AnalyzeContext, Transform, analyze
from kiln.operators.split import split_hash, splits_of
from kiln.plans.fixtures import ORDER_LABEL, laptop_raw, orders_split

# Screen flags: output name → literal keyword (fixed values of the laptop feature flow).
SCREEN_FLAGS = {
    "has_ips_panel": "ips panel",
    "has_touchscreen": "touchscreen",
    "is_4k": "4k ultra hd",
    "is_retina": "retina display",
    "is_full_hd": "full hd",
    "is_quad_hd": "quad hd+",
}
# Screen-size bucket edges in inches (fixed values).
INCH_EDGES = [14.0, 15.6]


def laptop_preprocess(i: dict[str, Column], ctx: AnalyzeContext) -> dict[str, Column]:
    """The laptop feature function: parse raw strings, vocabularies and z-scores from train."""
    o: dict[str, Column] = {}
    o["company_xf"] = ctx.vocab(X.default_if_empty(i["Company"]))
    st = X.parse_storage(F.trim(i["Memory"]))
    o["scaled_ssd"] = ctx.zscore(st["ssd_gb"])
    o["scaled_hdd"] = ctx.zscore(st["hdd_gb"])
    o["scaled_flash"] = ctx.zscore(st["flash_gb"])
    o["scaled_total"] = ctx.zscore(st["total_storage_gb"])
    o["ram_scaled"] = ctx.zscore(X.parse_unit(i["Ram"], "gb"))
    o["opsys_xf"] = ctx.vocab(X.map_os(i["OpSys"]))
    o["typename_xf"] = ctx.vocab(X.lower_trim(i["TypeName"]))
    res = X.parse_resolution(i["ScreenResolution"])
    o["scaled_width"] = ctx.zscore(res["width"])
    o["scaled_height"] = ctx.zscore(res["height"])
    for name, kw in SCREEN_FLAGS.items():
        o[name] = X.flag_contains(i["ScreenResolution"], kw)
    cpu = X.parse_cpu(i["Cpu"])
    o["cpu_brand_xf"] = ctx.vocab(cpu["brand"])
    o["cpu_family_xf"] = ctx.vocab(cpu["family"])
    o["scaled_cpu_clock_speed_ghz"] = ctx.zscore(cpu["clock_ghz"])
    o["gpu_brand_xf"] = ctx.vocab(X.token_at(i["Gpu"], 0))
    o["gpu_model_xf"] = ctx.vocab(X.token_at(i["Gpu"], 1))
    o["inches_bucket"] = X.bucketize(i["Inches"].cast("float"), INCH_EDGES)
    o["scaled_weight"] = ctx.zscore(X.parse_unit(i["Weight"], "kg"))
    o["scaled_price"] = ctx.zscore(ctx.impute_mean(i["Price"]))
    return o


def laptop_analyze(spark: SparkSession, sf_dir: str) -> tuple[Transform, dict[str, DataFrame]]:
    """Hash-split the laptop rows, analyze on train only; returns the transform and the splits
    (plus the whole tagged table under ``"all"``)."""
    tagged = split_hash(laptop_raw(spark, sf_dir), "Unname", seed=42)
    parts = splits_of(tagged, names=("train", "eval", "test"))
    parts["all"] = tagged
    return analyze(parts["train"], laptop_preprocess, keep=["Unname"]), parts


def laptop_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transformed rows of every split, tagged with the split (each split's own rows).

    The frozen transform is applied once to the tagged table: one scan and one lookup per
    vocabulary for all splits, with statistics from the train rows only.
    """
    tf, parts = laptop_analyze(spark, sf_dir)
    return tf.apply(parts["all"], keep=["Unname", "split"])


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headline validation result for the orders stand-in.

    Profiles train/eval/serving in one pass, infers the schema from train, relaxes the priority domain to 0.9,
    marks the label as absent in SERVING, sets skew/drift thresholds, and reports every check as
    (check, feature, value, threshold, is_anomaly).
    """
    prof = ST.profile_splits(orders_split(spark, sf_dir), ("train", "eval", "serving"),
                             remove={"o_orderkey", "pos"}, exclude={"serving": {ORDER_LABEL}})   # one pass
    schema = S.infer_schema(prof["train"])
    schema = S.not_in_environment(S.add_environment(schema, "TRAINING", "SERVING"), ORDER_LABEL, "SERVING")
    schema = S.set_feature(schema, "o_orderpriority", min_domain_mass=0.9, drift_threshold=0.03,
                           skew_threshold=0.03)
    mass = V.domain_mass(prof["eval"]["freq"], schema).select(
        F.lit("domain_mass").alias("check"), "feature", F.col("in_domain").alias("value"),
        F.col("min_domain_mass").alias("threshold"), "is_anomaly")
    skew = V.skew_linf(prof["train"]["freq"], prof["serving"]["freq"], schema).select(
        F.lit("skew").alias("check"), "feature", F.col("distance").alias("value"), "threshold", "is_anomaly")
    drift = V.drift_linf(prof["eval"]["freq"], prof["train"]["freq"], schema).select(
        F.lit("drift").alias("check"), "feature", F.col("distance").alias("value"), "threshold", "is_anomaly")
    missing = V.validate_missing_column(prof["serving"], schema, "SERVING").select(
        F.lit("missing_column").alias("check"), "feature", F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("is_anomaly"))
    return mass.unionByName(skew).unionByName(drift).unionByName(missing)
