"""Spark-native warehouse ETL: raw CRM and ERP tables to a tested star schema."""

from sluiceway.session import configure

__all__ = ["configure"]
