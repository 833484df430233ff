"""Incident analytics on Spark: rollups, alerts and live feeds over keyed JSON reports."""
