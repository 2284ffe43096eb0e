"""Micro-batch delivery, rollup maintenance, alerting and the running application."""
