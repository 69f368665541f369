"""Cohort, attribution, measure, risk, cost and episode operators."""
