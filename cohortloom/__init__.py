"""Cohort and feature extraction over star-schema health records, on Spark."""
