"""Every query of the inventory over the given tables, with the SQL it is checked against."""

from __future__ import annotations

from . import auditing, exporting, extract, publishing, quality, registering, typing

KEYS = {
    **extract.KEYS,
    **typing.KEYS,
    **publishing.KEYS,
    **exporting.KEYS,
    **quality.KEYS,
    **registering.KEYS,
    **auditing.KEYS,
}


def flagship(spark, sf):
    return publishing.load_report(spark, sf)
