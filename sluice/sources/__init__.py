"""Sources: raw lake zone and JDBC."""
