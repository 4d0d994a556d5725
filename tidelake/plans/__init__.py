"""The seven rental questions, the star schema and the layered daily jobs."""
