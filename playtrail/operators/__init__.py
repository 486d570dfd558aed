"""Operators: DataFrame -> DataFrame steps of the attribution and its reports."""
