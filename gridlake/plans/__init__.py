"""Table builds: bronze to silver, silver to gold, reports."""
