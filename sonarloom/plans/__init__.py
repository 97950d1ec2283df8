"""Catalogue of queries over the driver's tables, each with equivalent DuckDB SQL."""
