"""geoweave.functions"""
