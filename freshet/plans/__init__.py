"""Whole-record plans and the batch job."""
