"""One-to-many: menus, images and course items from source rows and payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlight.functions.text import blank_to_null, parse_price
from harborlight.operators.headers import MENU_SLOTS, first_filled
from harborlight.sources.envelopes import course_items

def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that later expressions read instead of computing it anew: a generator keeps the optimiser from inlining it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_menus(rows: DataFrame) -> DataFrame:
    """rows (of headers.resolved) with `menus`, the menus of each in order (GEN-1 to GEN-4): array of menu_name, price, display_order, is_representative.

    Numbered slots come first, then the single-item headers, then any other numbered pair. A name (ignoring case) counts once;
    slots keep their number as order, later ones get the running count; the first menu is representative.
    """
    kind = "array<struct<menu_name:string,price:int,display_order:int,is_representative:boolean>>"
    read = F.transform("_slots", lambda s: F.struct(first_filled(s["names"]).alias("name"), first_filled(s["prices"]).alias("price"), s["slot"].alias("slot")))

    def menu(x: Column, before: Column) -> Column:
        return F.struct(x["name"].alias("menu_name"), parse_price(x["price"]).alias("price"), F.coalesce(x["slot"], before + 1).alias("display_order"), (before == 0).alias("is_representative"))

    def add(done: Column, x: Column) -> Column:
        known = F.exists(done, lambda d: F.lower(d["menu_name"]) == F.lower(x["name"]))
        return F.when(known, done).otherwise(F.concat(done, F.array(menu(x, F.size(done))).cast(kind)))

    found = once(rows, "_found", F.filter(read, lambda x: x["name"].isNotNull()))
    several = F.aggregate("_found", F.array().cast(kind), add)
    return once(found, "menus", F.when(F.size("_found") <= 1, F.transform("_found", lambda x: menu(x, F.lit(0))).cast(kind)).otherwise(several)).drop("_found")


def unpivot_menus(rows: DataFrame, key: str, slots: int = MENU_SLOTS) -> DataFrame:
    """Wide name1, price1 .. columns as menu rows: key, menu_name, price, display_order (GEN-1 on typed columns, GEN-4)."""
    items = F.array(*[F.struct(F.lit(i).alias("slot"), blank_to_null(F.col(f"name{i}")).alias("menu_name"), F.col(f"price{i}").alias("price")) for i in range(1, slots + 1)])
    long = rows.select(key, F.inline(items)).filter("menu_name is not null")
    same = Window.partitionBy(key, F.lower("menu_name")).orderBy("slot")
    kept = long.withColumn("_n", F.row_number().over(same)).filter("_n = 1")
    return kept.select(key, "menu_name", "price", F.col("slot").alias("display_order"), (F.row_number().over(Window.partitionBy(key).orderBy("slot")) == 1).alias("is_representative"))


def spot_images(spots: DataFrame, content_id: str = "content_id") -> DataFrame:
    """Images of each spot (GEN-5): columns common, image (variants) become content_id, serial_num, origin_img_url, small_img_url, img_name, cpyrht_div_cd.

    Items without address are skipped, a missing serial is the count so far plus one, a known serial is dropped; a spot left
    without images gets its first image.
    """
    text = lambda v, n: F.nullif(F.trim(F.try_variant_get(v, f"$.{n}", "string")), F.lit(""))
    items = F.coalesce(course_items(F.col("image")), F.array().cast("array<variant>"))
    kind = "array<struct<serial_num:string,origin_img_url:string,small_img_url:string,img_name:string,cpyrht_div_cd:string>>"

    def add(done: Column, x: Column) -> Column:
        serial = F.coalesce(text(x, "serialnum"), (F.size(done) + 1).cast("string"))
        new = F.struct(serial.alias("serial_num"), text(x, "originimgurl").alias("origin_img_url"), text(x, "smallimageurl").alias("small_img_url"), text(x, "imgname").alias("img_name"), text(x, "cpyrhtDivCd").alias("cpyrht_div_cd"))
        skip = text(x, "originimgurl").isNull() | F.exists(done, lambda d: d["serial_num"] == serial)
        return F.when(skip, done).otherwise(F.concat(done, F.array(new).cast(kind)))

    listed = F.aggregate(items, F.array().cast(kind), add)
    common = F.col("common")
    first = F.struct(F.lit("1").alias("serial_num"), text(common, "firstimage").alias("origin_img_url"), text(common, "firstimage2").alias("small_img_url"), F.lit(None).cast("string").alias("img_name"), text(common, "cpyrhtDivCd").alias("cpyrht_div_cd"))
    fallback = F.when(text(common, "firstimage").isNotNull(), F.array(first).cast(kind))
    rows = spots.withColumn("_images", listed)
    return rows.select(content_id, F.inline(F.when(F.size("_images") > 0, F.col("_images")).otherwise(fallback)))


def number_course_items(items: DataFrame, course: str = "course_content_id") -> DataFrame:
    """Items of each course renumbered 1..N by integer subnum, those without one last in input order `pos` (GEN-6, WIN-10)."""
    number = F.trim("subnum").try_cast("int")
    order = Window.partitionBy(course).orderBy(number.isNull(), number, "pos")
    return items.withColumn("serial_num", F.row_number().over(order)).drop("subnum", "pos")


def place_children(places: DataFrame) -> dict[str, DataFrame]:
    """Parsed place rows (with menus and fetched_at) as the four written tables (GEN-9): observations are menus with a price."""
    key = ["source", "external_id"]
    menus = places.select(*key, F.col("menu_source").alias("menu_source"), "source_type", "fetched_at", F.inline("menus"))
    own = [c for c in places.columns if c not in ("menus", "row", "menu_source", "source_type", "fetched_at")]
    observed = menus.filter("price is not null").select(*key, "menu_name", F.col("price").alias("observed_price"), "source_type", F.col("fetched_at").alias("observed_at"))
    return {
        "places": places.select(*own),
        "sources": places.select(*key, "source_region", F.to_json("row").alias("raw_json"), "fetched_at"),
        "menus": menus.select(*key, "menu_name", "price", "display_order", "is_representative", "menu_source"),
        "observations": observed,
    }
