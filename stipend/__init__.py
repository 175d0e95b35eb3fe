"""Payroll and incentive data jobs as plain functions from DataFrames to DataFrames."""
