"""geoweave.sources"""
