"""Schemas of the tables: what extractors deliver, and the records that come out."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D = T.StringType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: The fields of each section, in their order.
STORE = {"name": _S, "address": _S, "phone": _S, "email": _S, "website": _S}
RECEIPT = {
    "source_image_id": _S,
    "transaction_ref": _S,
    "transaction_ref_label": _S,
    "register_ref": _S,
    "date": T.DateType(),
    "time": _S,
    "staff_name": _S,
    "customer_name": _S,
    "payment_method": _S,
    "subtotal": _D,
    "discount": _D,
    "vat": _D,
    "consumption_tax": _D,
    "total": _D,
    "total_in_words": _S,
    "extras": _S,
}
ITEM = {"description": _S, "quantity": _D, "unit_price": _D, "line_total": _D}
REQUIRED = {
    "store": ("name", "address"),
    "receipt": ("total", "transaction_ref", "date", "source_image_id"),
    "line_item": ("description", "quantity", "unit_price", "line_total"),
}
REASONS = ("low_confidence", "conflicting_extractions", "validation_failed", "illegible", "manual_flag", "extraction_failed")
STATUSES = ("pending", "resolved", "rejected")

_SCORES = T.MapType(_S, _D)
CANDIDATE = _struct(store=_struct(**STORE), receipt=_struct(**RECEIPT), line_items=T.ArrayType(_struct(**ITEM)))
CONFIDENCE = _struct(store=_SCORES, receipt=_SCORES, line_items=T.ArrayType(_SCORES))
FAILURE = _struct(
    field_name=_S, extractor_source=_S, extracted_value=_S, confidence_score=_D, flagged_reason=_S, status=_S, extractor_notes=_S
)
#: One extractor's answer for one receipt: a candidate with confidences, or a failure.
EXTRACTION = _struct(
    receipt_id=_S, result_index=T.IntegerType(), source=_S, candidate=CANDIDATE, confidence=CONFIDENCE, failure=FAILURE
)
#: All answers for one receipt in one document.
DOCUMENT = _struct(
    receipt_id=_S, results=T.ArrayType(_struct(source=_S, candidate=CANDIDATE, confidence=CONFIDENCE, failure=FAILURE))
)
REVIEW = _struct(
    field_name=_S, extractor_source=_S, extracted_value=_S, confidence_score=_D, flagged_reason=_S, extractor_notes=_S
)
