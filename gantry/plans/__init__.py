"""Layer plans, the medallion run and the report marts."""
