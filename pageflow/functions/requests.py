"""The document sent to the conversion service for one page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageflow.settings import IMAGE_MODE, PAGE_MODE


def mode(use_image: Column) -> Column:
    return F.when(use_image, F.lit(IMAGE_MODE)).otherwise(F.lit(PAGE_MODE))


def choose_payload(use_image: Column, page: Column, image: Column) -> Column:
    return F.when(use_image, image).otherwise(page)


def request_document(
    use_image: Column,
    payload: Column,
    page_number: Column,
    include_images: bool = True,
    include_ocr: bool = True,
) -> Column:
    """JSON request; ``to_json`` leaves out a null page number."""
    image_request = F.to_json(F.struct(F.struct(payload.alias("page_image_base64_encoding")).alias("parameters")))
    page_request = F.to_json(
        F.struct(
            F.struct(
                payload.alias("pdf_encoding"),
                F.lit(include_images).alias("include_images"),
                F.lit(include_ocr).alias("include_ocr"),
                page_number.alias("page_number"),
            ).alias("parameters")
        )
    )
    return F.when(use_image, image_request).otherwise(page_request)
