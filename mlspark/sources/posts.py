"""Image reference of a social post whose embed comes in three shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IMAGES = "array<struct<image: struct<ref: struct<link: string>>>>"

POST_SCHEMA = f"""author struct<did: string>,
 record struct<embed: struct<
   images: {IMAGES},
   media: struct<images: {IMAGES}>,
   record: struct<embeds: array<struct<images: {IMAGES}>>>>>"""

# fixed value: address form of a full-size image
IMAGE_URL = "https://cdn.bsky.app/img/feed_fullsize/plain/%s/%s@jpeg"


def first_image_ref(posts: DataFrame, post: str = "post", out: str = "image_url") -> DataFrame:
    """Own images, else images attached to a quote, else the first quoted embed that has images."""
    embed = F.col(f"{post}.record.embed")
    quoted = F.filter(embed["record"]["embeds"], lambda e: e["images"].isNotNull())
    images: Column = F.coalesce(embed["images"], embed["media"]["images"], F.get(quoted, 0)["images"])
    link = F.get(images, 0)["image"]["ref"]["link"]
    url = F.format_string(IMAGE_URL, F.col(f"{post}.author.did"), link)
    return posts.withColumn(out, F.when(F.length(link) > 0, url))
