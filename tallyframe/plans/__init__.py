"""The reports.  Each takes a table set and parameters and returns a DataFrame; callers write it where they like."""

from tallyframe.plans.cip import cip_listing, cip_rollforward
from tallyframe.plans.nbv import nbv_detail, nbv_summary
from tallyframe.plans.payables import payment_details
from tallyframe.plans.property_tax import property_tax_by_location, property_tax_detail, property_tax_summary
from tallyframe.plans.rollforward import asset_rollforward
from tallyframe.plans.suppliers import supplier_directory

__all__ = [
    "asset_rollforward",
    "cip_listing",
    "cip_rollforward",
    "nbv_detail",
    "nbv_summary",
    "payment_details",
    "property_tax_by_location",
    "property_tax_detail",
    "property_tax_summary",
    "supplier_directory",
]
