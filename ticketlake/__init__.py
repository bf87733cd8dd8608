"""Ticket-analytics lakehouse operators written as plain Spark DataFrame functions."""
