"""Credit-portfolio analytics on Spark: cleanse, audit, model and serve loan data."""
