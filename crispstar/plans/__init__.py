"""The layers: silver cleaning, gold star schema, KPI queries and the whole build."""
