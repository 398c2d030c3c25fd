"""flowsieve: finding rare suspicious payments in large transaction tables with Spark."""
