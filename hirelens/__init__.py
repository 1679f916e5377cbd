"""Job-market analytics as plain functions from DataFrame to DataFrame."""
