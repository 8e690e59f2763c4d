"""Synthetic listings and places, made from the driver's tables by integer arithmetic; one text for both engines.

The tables hold no listings. Everything that these statements make is invented and only there to run the operators.
"""

LISTINGS = """
SELECT o_orderkey AS row_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'urbania' WHEN 1 THEN 'adondevivir' WHEN 2 THEN 'mercadolibre' WHEN 3 THEN 'manual' ELSE 'other' END AS source,
  concat('L', o_orderkey) AS source_listing_id,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE concat('https://www.portal.test/aviso/', o_orderkey, '/') END AS source_url,
  CASE WHEN o_orderkey % 7 = 0 THEN 'San Isidro' WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'Miraflores' END AS district,
  CASE WHEN o_orderkey % 3 = 0 THEN concat('Calle Berlin ', 100 + o_orderkey % 800) ELSE 'Miraflores' END AS address,
  CASE WHEN o_orderkey % 29 = 0 THEN 'Casa' ELSE 'Flat' END AS property_type,
  CASE WHEN o_orderkey % 31 = 0 THEN 'Venta' ELSE 'Alquiler' END AS operation,
  concat('Piso de ', 1 + o_orderkey % 3, ' dormitorios') AS title,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Contrato minimo 1 año, 2 meses de garantia. Acepta extranjeros.' ELSE 'Flat amoblado con balcon, ascensor y vista a la calle. Piso 9.' END AS description,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS INT) END AS bedrooms,
  CAST(1 + o_orderkey % 3 AS DOUBLE) AS bathrooms,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(500 + (o_orderkey * 37) % 800 AS DOUBLE) END AS rent_usd,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(500 + (o_orderkey * 37) % 800 AS DOUBLE) END AS rent_original,
  CASE WHEN o_orderkey % 6 = 0 THEN 'PEN' ELSE 'USD' END AS rent_currency,
  CASE WHEN o_orderkey % 6 = 0 THEN 'CALCULATED' ELSE 'PUBLISHED' END AS rent_usd_basis,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(40 + (o_orderkey * 13) % 150 AS DOUBLE) END AS maintenance_usd,
  CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 2 = 0 THEN NULL ELSE CAST(540 + (o_orderkey * 37) % 800 + (o_orderkey * 13) % 150 AS DOUBLE) END AS estimated_total_monthly_usd,
  CASE WHEN o_orderkey % 12 = 0 THEN TRUE ELSE NULL END AS maintenance_included_in_rent,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(20 + (o_orderkey * 7) % 110 AS DOUBLE) END AS built_area_m2,
  CAST(25 + (o_orderkey * 11) % 120 AS DOUBLE) AS total_area_m2,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE -12.150 + CAST((o_orderkey * 7919) % 60000 AS DOUBLE) / 1000000.0 END AS latitude,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE -77.065 + CAST((o_orderkey * 104729) % 70000 AS DOUBLE) / 1000000.0 END AS longitude,
  CASE o_orderkey % 4 WHEN 0 THEN 'EXACT' WHEN 1 THEN 'APPROXIMATE' WHEN 2 THEN 'UNSPECIFIED' ELSE 'STREET_NUMBER' END AS coord_precision,
  CASE o_orderkey % 9 WHEN 0 THEN 'INACTIVE' WHEN 1 THEN 'ACTIVE_CONFIRMED' WHEN 2 THEN NULL WHEN 3 THEN 'UNKNOWN' ELSE 'LIKELY_ACTIVE' END AS active_status,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '2024-05-20' END AS publication_date,
  CASE o_orderkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END AS furnished,
  CASE WHEN o_orderkey % 8 = 1 THEN TRUE ELSE NULL END AS semi_furnished,
  CASE WHEN o_orderkey % 4 = 1 THEN TRUE ELSE NULL END AS balcony,
  CASE WHEN o_orderkey % 5 = 1 THEN TRUE ELSE FALSE END AS laundry,
  CASE WHEN o_orderkey % 7 = 3 THEN TRUE ELSE NULL END AS interior_view,
  CASE WHEN o_orderkey % 7 = 4 THEN TRUE ELSE NULL END AS exterior_view,
  CASE WHEN o_orderkey % 13 = 5 THEN TRUE ELSE NULL END AS avenue_view,
  CASE WHEN o_orderkey % 11 = 6 THEN TRUE ELSE NULL END AS acoustic_windows,
  CASE WHEN o_orderkey % 10 = 7 THEN TRUE ELSE NULL END AS quiet_claim,
  CASE WHEN o_orderkey % 2 = 1 THEN TRUE ELSE NULL END AS elevator,
  CASE WHEN o_orderkey % 3 = 1 THEN TRUE ELSE NULL END AS security_24h,
  CASE WHEN o_orderkey % 6 = 1 THEN TRUE ELSE NULL END AS gym,
  CASE WHEN o_orderkey % 43 = 0 THEN TRUE ELSE NULL END AS shared_room_text,
  CASE WHEN o_orderkey % 14 = 0 THEN TRUE ELSE NULL END AS studio_text,
  CASE WHEN o_orderkey % 21 = 0 THEN TRUE ELSE NULL END AS short_term_text,
  CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_orderkey % 15 AS INT) ELSE NULL END AS floor,
  CASE WHEN o_orderkey % 4 = 2 THEN CAST(o_orderkey % 3 AS INT) ELSE NULL END AS parking_spaces,
  CAST(o_orderkey % 12 AS INT) AS image_count,
  CASE WHEN o_orderkey % 6 = 2 THEN CAST(1 + o_orderkey % 4 AS DOUBLE) ELSE NULL END AS deposit_months,
  CASE WHEN o_orderkey % 5 = 2 THEN CAST(6 * (1 + o_orderkey % 4) AS INT) ELSE NULL END AS minimum_contract_months,
  CASE WHEN o_orderkey % 3 = 0 THEN concat('+519', 10000000 + o_orderkey % 90000000) ELSE NULL END AS phone,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Agencia' ELSE NULL END AS agency_name,
  CASE WHEN o_orderkey % 3 = 1 THEN 2 ELSE 1 END AS number_of_sources,
  CASE WHEN o_orderkey % 26 = 0 THEN 'G0001' ELSE '' END AS possible_duplicate_of,
  CASE WHEN o_orderkey % 27 = 0 THEN 'PRICE_MISMATCH' ELSE '' END AS dup_inconsistencies,
  TRUE AS is_canonical,
  concat('G', o_orderkey) AS duplicate_group_id,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey * 17) % 420 AS INT) END AS dist_major_road_m,
  'Av. Larco' AS major_road_name,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey * 19) % 160 AS INT) END AS dist_arterial_road_m,
  'Calle Schell' AS arterial_road_name,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey * 23) % 900 AS INT) END AS dist_nightclub_m,
  'Club' AS nightclub_name,
  CAST(o_orderkey % 5 AS INT) AS bars_within_m,
  CAST(o_orderkey % 14 AS INT) AS restaurants_within_m,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey * 29) % 1000 AS INT) END AS dist_supermarket_m,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey * 31) % 800 AS INT) END AS dist_pharmacy_m,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey * 37) % 600 AS INT) END AS dist_park_m,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey * 41) % 700 AS INT) END AS dist_cafe_m,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey * 43) % 900 AS INT) END AS dist_transit_m,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST((o_orderkey * 47) % 2000 AS INT) END AS dist_malecon_m,
  CASE WHEN o_orderkey % 10 = 9 THEN NULL WHEN o_orderkey % 7 = 0 THEN FALSE ELSE TRUE END AS inside_district_polygon,
  CASE WHEN o_orderkey % 10 = 9 THEN NULL WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey % 500 AS INT) ELSE 0 END AS dist_outside_district_m
FROM orders
"""

#: Point places from suppliers: (layer, name, seq, lat, lon).
PLACES = """
SELECT CASE s_suppkey % 4 WHEN 0 THEN 'bar' WHEN 1 THEN 'park' WHEN 2 THEN 'cafe' ELSE 'restaurant' END AS layer, s_name AS name, CAST(s_suppkey AS INT) AS seq,
  -12.150 + CAST((s_suppkey * 15485863) % 60000 AS DOUBLE) / 1000000.0 AS lat, -77.065 + CAST((s_suppkey * 32452843) % 70000 AS DOUBLE) / 1000000.0 AS lon
FROM supplier
"""
