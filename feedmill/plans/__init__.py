"""What each feed does between landing and its core table, and the loads themselves."""
