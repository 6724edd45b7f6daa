"""feedloom: periodic data feeds to a queryable star schema, as Spark DataFrame plans.

Library functions take DataFrames or a session and never create one.
"""
