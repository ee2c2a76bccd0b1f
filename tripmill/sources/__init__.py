"""Reading and writing of trip, zone, weather and model data."""
