"""firnline: along-track sensor records and gridded products on PySpark DataFrames."""
