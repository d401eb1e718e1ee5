"""Labels of tasks in exchange forms: flat records, BIO tokens, image boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.operators.jobs import numbered


def flat_records(annotations: DataFrame) -> DataFrame:
    """(id, labels): a map from each control's name to its values, of a task's newest annotation; tasks without any
    have an empty map."""
    newest = annotations.filter(F.coalesce("annotation_no", F.lit(0)) == 0)
    pairs = newest.filter("from_name is not null").groupBy("id", "from_name").agg(F.array_sort(F.collect_list("value")).alias("values"))
    maps = pairs.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("from_name", "values")))).alias("labels"))
    return newest.select("id").distinct().join(maps, "id", "left").withColumn("labels", F.coalesce("labels", F.create_map().cast("map<string,array<string>>")))


def bio_tokens(texts: DataFrame, spans: DataFrame, key: str, text: str) -> DataFrame:
    """(key, token_idx, token, tag): words with B-, I- or O by the spans (key, start, end, label; end exclusive) they
    begin in; of several the first span counts."""
    # a word begins after the words before it and the white space between
    parts = F.regexp_extract_all(F.col(text), F.lit(r"(?U)(\s*\S+)"), 1)
    t = texts.select(key, F.posexplode(parts).alias("token_idx", "_part"))
    end = F.sum(F.length("_part")).over(Window.partitionBy(key).orderBy("token_idx"))
    t = t.withColumn("token", F.regexp_extract("_part", r"(?U)(\S+)", 1)).withColumn("_at", end - F.length("token")).drop("_part")
    s = spans.select(F.col(key).alias("_k"), "start", "end", "label")
    hit = t.join(s, (F.col(key) == F.col("_k")) & (F.col("_at") >= F.col("start")) & (F.col("_at") < F.col("end")), "left")
    one = hit.groupBy(key, "token_idx", "token").agg(F.min(F.struct("start", "label")).alias("span"))
    before = F.lag("span").over(Window.partitionBy(key).orderBy("token_idx"))
    tag = F.when(F.col("span.label").isNull(), "O").when(F.coalesce(before["start"] == F.col("span.start"), F.lit(False)), F.concat(F.lit("I-"), F.col("span.label"))).otherwise(F.concat(F.lit("B-"), F.col("span.label")))
    return one.withColumn("tag", tag).drop("span")


def rotated_box(x: Column, y: Column, w: Column, h: Column, degrees: Column) -> Column:
    """struct(x, y, w, h): the upright box around a rectangle turned about its top left corner."""
    r = F.radians(degrees)
    xs = F.array(F.lit(0.0), w * F.cos(r), -h * F.sin(r), w * F.cos(r) - h * F.sin(r))
    ys = F.array(F.lit(0.0), w * F.sin(r), h * F.cos(r), w * F.sin(r) + h * F.cos(r))
    lo_x, lo_y = F.array_min(xs), F.array_min(ys)
    return F.struct((x + lo_x).alias("x"), (y + lo_y).alias("y"), (F.array_max(xs) - lo_x).alias("w"), (F.array_max(ys) - lo_y).alias("h"))


def pixel_boxes(df: DataFrame) -> DataFrame:
    """Boxes (x, y, w, h in percent, optional rotation as degrees) in pixels of width x height, with area."""
    b = rotated_box(F.col("x") * F.col("width") / 100, F.col("y") * F.col("height") / 100, F.col("w") * F.col("width") / 100, F.col("h") * F.col("height") / 100, F.coalesce("degrees", F.lit(0.0)))
    return df.withColumn("box", b).withColumn("area", F.col("box.w") * F.col("box.h"))


def centre_lines(df: DataFrame, label_id: str) -> DataFrame:
    """A text line a box: label id, centre and size as shares of the image, clamped to it."""
    share = lambda c, size: F.least(F.lit(1.0), F.greatest(F.lit(0.0), c / size))
    p = pixel_boxes(df)
    nums = [share(F.col("box.x") + F.col("box.w") / 2, F.col("width")), share(F.col("box.y") + F.col("box.h") / 2, F.col("height")), share(F.col("box.w"), F.col("width")), share(F.col("box.h"), F.col("height"))]
    return p.withColumn("line", F.concat_ws(" ", F.col(label_id).cast("string"), *[F.format_string("%.6f", n) for n in nums]))


def corner_boxes(df: DataFrame) -> DataFrame:
    """Whole-pixel corners (xmin, ymin, xmax, ymax), cut towards zero."""
    p = pixel_boxes(df)
    return p.select(*df.columns, F.col("box.x").cast("int").alias("xmin"), F.col("box.y").cast("int").alias("ymin"), (F.col("box.x") + F.col("box.w")).cast("int").alias("xmax"), (F.col("box.y") + F.col("box.h")).cast("int").alias("ymax"))


def conll_lines(tokens: DataFrame, key: str) -> DataFrame:
    """(key, line_no, line): ``token -X- _ tag`` of each token of bio_tokens(), a blank line after each text."""
    word = tokens.select(key, F.col("token_idx").alias("line_no"), F.concat_ws(" ", "token", F.lit("-X-"), F.lit("_"), "tag").alias("line"))
    ends = tokens.groupBy(key).agg((F.max("token_idx") + 1).alias("line_no")).select(key, "line_no", F.lit("").alias("line"))
    return word.unionByName(ends)


def flat_table(records: DataFrame, names: list[str], separator: str = "|") -> DataFrame:
    """(id, a column a control): flat_records() for CSV and TSV; several values are joined, none is ''."""
    return records.select("id", *[F.coalesce(F.array_join(F.try_element_at("labels", F.lit(n)), separator), F.lit("")).alias(n) for n in names])


def said(value: Column) -> Column:
    """A transcription that is text, or an object whose text is a list: its first entry."""
    return F.coalesce(F.get_json_object(value, "$.text[0]"), F.get_json_object(value, "$.text"), value)


def asr_manifest(df: DataFrame, audio: str, text: str, duration: str) -> DataFrame:
    """A JSON line a record: audio_filepath, duration, text; records without text are left out."""
    return df.filter(F.coalesce(F.trim(text), F.lit("")) != "").select(F.to_json(F.struct(F.col(audio).alias("audio_filepath"), F.col(duration).alias("duration"), F.col(text).alias("text"))).alias("value"))


def shoelace(points: Column) -> Column:
    """Area of a polygon of array<struct<x, y>>."""
    n = F.size(points)
    at = lambda i: F.get(points, i % n)
    parts = F.transform(points, lambda p, i: p["x"] * at(i + 1)["y"] - at(i + 1)["x"] * p["y"])
    return F.abs(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)) / 2


def polygon_box(points: Column) -> Column:
    """struct(x, y, w, h): the upright box of a polygon."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x"), F.array_min(ys).alias("y"), (F.array_max(xs) - F.array_min(xs)).alias("w"), (F.array_max(ys) - F.array_min(ys)).alias("h"))


def coco_rows(boxes: DataFrame, image: str, label: str) -> dict[str, DataFrame]:
    """images, categories and annotations of boxes (x, y, w, h in percent, width, height): dense ids from 0 by name."""
    images = numbered(boxes.select(image, "width", "height").distinct(), [F.col(image)], "id")
    categories = numbered(boxes.select(label).distinct(), [F.col(label)], "id")
    of = pixel_boxes(boxes).join(images.select(image, F.col("id").alias("image_id")), image).join(categories.select(label, F.col("id").alias("category_id")), label)
    four = F.array("box.x", "box.y", "box.w", "box.h")
    notes = numbered(of, [F.col("image_id"), F.col("category_id"), four], "id").select("id", "image_id", "category_id", four.alias("bbox"), "area", F.lit(0).alias("iscrowd"))
    return {"images": images.select("id", F.col(image).alias("file_name"), "width", "height"), "categories": categories.select("id", F.col(label).alias("name")), "annotations": notes}


def label_files(lines: DataFrame, image: str) -> DataFrame:
    """(image, content): the lines of each image's label file, in order. An image's boxes fit one row."""
    return lines.groupBy(image).agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("content"))


def voc_xml(corners: DataFrame, image: str, label: str) -> DataFrame:
    """(image, content): the XML of each image's boxes, which fit one row."""
    text = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    box = F.concat(*[x for n in ("xmin", "ymin", "xmax", "ymax") for x in (F.lit(f"<{n}>"), F.col(n).cast("string"), F.lit(f"</{n}>"))])
    one = F.concat(F.lit("<object><name>"), text(F.col(label)), F.lit("</name><bndbox>"), box, F.lit("</bndbox></object>"))
    per = corners.groupBy(image, "width", "height").agg(F.array_join(F.array_sort(F.collect_list(one)), "").alias("o"))
    size = F.concat(F.lit("<size><width>"), F.col("width").cast("string"), F.lit("</width><height>"), F.col("height").cast("string"), F.lit("</height></size>"))
    return per.select(image, F.concat(F.lit("<annotation><filename>"), text(F.col(image)), F.lit("</filename>"), size, F.col("o"), F.lit("</annotation>")).alias("content"))


def tag_of(names: DataFrame, schema: DataFrame) -> DataFrame:
    """(from_name, tag): the tag of that name, else the longest whose pattern fits the name's beginning; NULL if none.

    schema is (tag, pattern) and small by nature: its rows are the controls of one labelling form.
    """
    fits = F.regexp_like("from_name", F.concat(F.lit("^(?:"), F.col("pattern"), F.lit(")")))
    j = names.select("from_name").distinct().join(schema, (F.col("from_name") == F.col("tag")) | fits, "left")
    return j.groupBy("from_name").agg(F.max_by("tag", F.struct((F.col("from_name") == F.col("tag")).alias("e"), F.length("tag").alias("n"), F.col("tag").alias("t"))).alias("tag"))
