"""Registered queries and their SQL."""

from __future__ import annotations

from firnline.plans import aux_queries, grid_queries, instrument_queries, lookup_queries, record_queries, segment_queries, waveform_queries, window_queries

QUERIES: dict = {}
SQL: dict = {}
for _module in (grid_queries, window_queries, segment_queries, record_queries, lookup_queries, waveform_queries, aux_queries, instrument_queries):
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
