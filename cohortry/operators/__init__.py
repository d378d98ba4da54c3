"""Relational building blocks of a cohort study.

Person tables may hold a few people with a very large share of all rows. Events are therefore
collapsed with map-side aggregation, to at most one row per person, date and feature, before any
join on ``person_id``; no task ever receives the raw rows of one person.
"""
