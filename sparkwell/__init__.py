"""Analytic jobs on Spark: sources, sinks, operators, functions and case studies."""
