"""geoweave.streaming"""
