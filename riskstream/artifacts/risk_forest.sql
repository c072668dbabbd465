SELECT * EXCLUDE (v0, v1, location_idx, merchant_category_idx), v1 / (v0 + v1) AS fraud_probability
FROM (SELECT *,
 (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 3.0e0, 4.0e0, 5.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 524.0e0/524.0e0 ELSE 0.0e0/501.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 231.0e0/233.0e0 ELSE 0.0e0/327.0e0 END END ELSE CASE WHEN amount <= 6276.409954298288e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 2872.0e0/2872.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 147.0e0/147.0e0 ELSE 0.0e0/15.0e0 END END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 1771.0e0/1771.0e0 ELSE 0.0e0/105.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/212.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 555.0e0/556.0e0 ELSE 0.0e0/31.0e0 END END ELSE 0.0e0/832.0e0 END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 796.0e0/799.0e0 ELSE 0.0e0/192.0e0 END ELSE 0.0e0/979.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 4627.0e0/4627.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 128.0e0/128.0e0 ELSE 0.0e0/83.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 30.0e0/30.0e0 ELSE 0.0e0/40.0e0 END END END ELSE CASE WHEN tx_hour <= 22.5e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 2.0e0, 3.0e0, 4.0e0, 5.0e0) THEN 493.0e0/948.0e0 ELSE CASE WHEN is_online <= 0.5e0 THEN 46.0e0/90.0e0 ELSE 39.0e0/106.0e0 END END ELSE 0.0e0/67.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 811.0e0/814.0e0 ELSE 0.0e0/804.0e0 END ELSE 0.0e0/367.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 2401.0e0/2401.0e0 ELSE CASE WHEN merchant_category_idx IN (0.0e0, 1.0e0, 4.0e0, 5.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 1576.0e0/1576.0e0 ELSE 0.0e0/66.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 711.0e0/711.0e0 ELSE 0.0e0/62.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN amount <= 1944.7414262685925e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 240.0e0/240.0e0 ELSE 0.0e0/3.0e0 END ELSE 314.0e0/339.0e0 END ELSE 0.0e0/608.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 859.0e0/862.0e0 ELSE 0.0e0/794.0e0 END ELSE CASE WHEN merchant_category_idx IN (0.0e0, 4.0e0, 5.0e0) THEN CASE WHEN amount <= 6276.409954298288e0 THEN 1506.0e0/1513.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 883.0e0/883.0e0 ELSE 0.0e0/43.0e0 END END ELSE 2267.0e0/2342.0e0 END END ELSE CASE WHEN merchant_category_idx IN (0.0e0, 2.0e0, 3.0e0, 4.0e0, 5.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/150.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 459.0e0/460.0e0 ELSE 0.0e0/17.0e0 END END ELSE 0.0e0/641.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/37.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 91.0e0/91.0e0 ELSE 0.0e0/5.0e0 END END ELSE 0.0e0/169.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 835.0e0/838.0e0 ELSE 0.0e0/801.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 4495.0e0/4495.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 150.0e0/150.0e0 ELSE 0.0e0/112.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/181.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 520.0e0/522.0e0 ELSE 0.0e0/30.0e0 END END ELSE 0.0e0/764.0e0 END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 836.0e0/838.0e0 ELSE 0.0e0/836.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 2377.0e0/2377.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 2229.0e0/2229.0e0 ELSE 0.0e0/116.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 3.0e0, 4.0e0, 5.0e0) THEN 376.0e0/498.0e0 ELSE CASE WHEN is_online <= 0.5e0 THEN CASE WHEN amount <= 2824.4428953621536e0 THEN 63.0e0/85.0e0 ELSE 33.0e0/67.0e0 END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/33.0e0 ELSE 93.0e0/99.0e0 END END END ELSE 0.0e0/852.0e0 END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 2.0e0, 3.0e0, 4.0e0, 5.0e0) THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 739.0e0/739.0e0 ELSE 0.0e0/116.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 128.0e0/128.0e0 ELSE 0.0e0/45.0e0 END END ELSE 0.0e0/1038.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 4509.0e0/4509.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 173.0e0/173.0e0 ELSE 0.0e0/117.0e0 END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 3.0e0, 4.0e0, 5.0e0) THEN 411.0e0/429.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 168.0e0/171.0e0 ELSE 0.0e0/15.0e0 END END ELSE 0.0e0/582.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 820.0e0/823.0e0 ELSE 0.0e0/773.0e0 END ELSE CASE WHEN amount <= 5321.41936593689e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 2440.0e0/2440.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 129.0e0/129.0e0 ELSE 0.0e0/1.0e0 END END ELSE CASE WHEN amount <= 6276.409954298288e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 445.0e0/445.0e0 ELSE 0.0e0/13.0e0 END ELSE 1624.0e0/1714.0e0 END END END ELSE CASE WHEN merchant_category_idx IN (4.0e0, 5.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/106.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 187.0e0/362.0e0 ELSE 0.0e0/19.0e0 END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/127.0e0 ELSE 385.0e0/417.0e0 END ELSE 0.0e0/575.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 2.5e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 427.0e0/429.0e0 ELSE 0.0e0/63.0e0 END ELSE 389.0e0/499.0e0 END ELSE 0.0e0/1006.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 2884.0e0/2890.0e0 ELSE CASE WHEN merchant_category_idx IN (3.0e0, 4.0e0, 5.0e0) THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 77.0e0/77.0e0 ELSE 0.0e0/12.0e0 END ELSE 59.0e0/83.0e0 END END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN location_idx IN (0.0e0, 2.0e0, 3.0e0) THEN 1656.0e0/1722.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 576.0e0/576.0e0 ELSE 0.0e0/45.0e0 END END ELSE 0.0e0/589.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 3272.0e0/3275.0e0 ELSE CASE WHEN merchant_category_idx IN (0.0e0, 2.0e0, 4.0e0, 5.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/468.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 1585.0e0/1585.0e0 ELSE 0.0e0/73.0e0 END END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/305.0e0 ELSE 722.0e0/766.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/186.0e0 ELSE CASE WHEN is_online <= 0.5e0 THEN 294.0e0/323.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 270.0e0/270.0e0 ELSE 0.0e0/9.0e0 END END END ELSE 0.0e0/830.0e0 END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 775.0e0/778.0e0 ELSE 0.0e0/797.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 4548.0e0/4548.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 165.0e0/165.0e0 ELSE 0.0e0/105.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN amount <= 644.2776380572468e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/12.0e0 ELSE 73.0e0/75.0e0 END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/167.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 484.0e0/487.0e0 ELSE 0.0e0/29.0e0 END END END ELSE 0.0e0/810.0e0 END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 842.0e0/845.0e0 ELSE 0.0e0/800.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 4479.0e0/4479.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 3.0e0) THEN 100.0e0/141.0e0 ELSE CASE WHEN merchant_category_idx IN (3.0e0, 4.0e0, 5.0e0) THEN 40.0e0/70.0e0 ELSE 38.0e0/86.0e0 END END END END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/365.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN CASE WHEN tx_hour <= 15.5e0 THEN 322.0e0/695.0e0 ELSE 259.0e0/459.0e0 END ELSE 0.0e0/84.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 826.0e0/829.0e0 ELSE 0.0e0/840.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 4554.0e0/4554.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 107.0e0/107.0e0 ELSE 0.0e0/74.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 26.0e0/26.0e0 ELSE 0.0e0/39.0e0 END END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/175.0e0 ELSE CASE WHEN merchant_category_idx IN (1.0e0, 3.0e0, 4.0e0) THEN 285.0e0/296.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 283.0e0/283.0e0 ELSE 0.0e0/23.0e0 END END END ELSE 0.0e0/807.0e0 END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 0.5e0 THEN 120.0e0/137.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 697.0e0/700.0e0 ELSE 0.0e0/156.0e0 END END ELSE 0.0e0/1060.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 2858.0e0/2896.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 8122.535017319024e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 1445.0e0/1445.0e0 ELSE 0.0e0/91.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 866.0e0/866.0e0 ELSE 0.0e0/33.0e0 END END ELSE 0.0e0/618.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 800.0e0/801.0e0 ELSE 0.0e0/155.0e0 END ELSE 0.0e0/996.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 4571.0e0/4571.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 154.0e0/154.0e0 ELSE 0.0e0/111.0e0 END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 589.0e0/594.0e0 ELSE 0.0e0/37.0e0 END ELSE 0.0e0/624.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 3.0e0, 5.0e0) THEN CASE WHEN tx_hour <= 2.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 255.0e0/255.0e0 ELSE 0.0e0/45.0e0 END ELSE 0.0e0/231.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN is_online <= 0.5e0 THEN 111.0e0/177.0e0 ELSE 109.0e0/238.0e0 END ELSE 0.0e0/100.0e0 END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 364.0e0/365.0e0 ELSE 0.0e0/101.0e0 END ELSE 0.0e0/564.0e0 END END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 4458.0e0/4458.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 134.0e0/134.0e0 ELSE 0.0e0/120.0e0 END END ELSE CASE WHEN tx_hour <= 22.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 560.0e0/560.0e0 ELSE 0.0e0/585.0e0 END ELSE 0.0e0/68.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN tx_hour <= 3.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 553.0e0/557.0e0 ELSE 0.0e0/578.0e0 END ELSE CASE WHEN location_idx IN (1.0e0, 2.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 151.0e0/151.0e0 ELSE 0.0e0/108.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 131.0e0/131.0e0 ELSE 0.0e0/118.0e0 END END END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 4422.0e0/4422.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 161.0e0/161.0e0 ELSE 0.0e0/125.0e0 END END END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/356.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 531.0e0/533.0e0 ELSE 0.0e0/21.0e0 END ELSE 0.0e0/630.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 4.5e0 THEN CASE WHEN location_idx IN (1.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 357.0e0/358.0e0 ELSE 0.0e0/319.0e0 END ELSE 304.0e0/679.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 108.0e0/108.0e0 ELSE 0.0e0/73.0e0 END ELSE CASE WHEN merchant_category_idx IN (0.0e0, 1.0e0, 2.0e0, 4.0e0, 5.0e0) THEN 34.0e0/59.0e0 ELSE 2.0e0/17.0e0 END END END ELSE 0.0e0/359.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 4576.0e0/4576.0e0 ELSE CASE WHEN location_idx IN (3.0e0) THEN 48.0e0/68.0e0 ELSE CASE WHEN is_online <= 0.5e0 THEN 59.0e0/103.0e0 ELSE 51.0e0/115.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 537.0e0/539.0e0 ELSE 0.0e0/36.0e0 END ELSE 0.0e0/570.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 765.0e0/768.0e0 ELSE 0.0e0/167.0e0 END ELSE 0.0e0/984.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 2851.0e0/2894.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN CASE WHEN merchant_category_idx IN (5.0e0) THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 422.0e0/422.0e0 ELSE 0.0e0/68.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 1881.0e0/1881.0e0 ELSE 0.0e0/493.0e0 END END ELSE 0.0e0/176.0e0 END END END)
 + (CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 4373.668956104666e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 728.0e0/728.0e0 ELSE 0.0e0/148.0e0 END ELSE CASE WHEN merchant_category_idx IN (0.0e0, 1.0e0) THEN 34.0e0/38.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 57.0e0/60.0e0 ELSE 0.0e0/31.0e0 END END END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 2448.0e0/2448.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 566.0e0/568.0e0 ELSE 0.0e0/38.0e0 END END END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 0.0e0/1038.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 2228.0e0/2228.0e0 ELSE 0.0e0/129.0e0 END ELSE 0.0e0/647.0e0 END END END) AS v0,
 (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 3.0e0, 4.0e0, 5.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/524.0e0 ELSE 501.0e0/501.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 2.0e0/233.0e0 ELSE 327.0e0/327.0e0 END END ELSE CASE WHEN amount <= 6276.409954298288e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/2872.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/147.0e0 ELSE 15.0e0/15.0e0 END END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/1771.0e0 ELSE 105.0e0/105.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 212.0e0/212.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 1.0e0/556.0e0 ELSE 31.0e0/31.0e0 END END ELSE 832.0e0/832.0e0 END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 3.0e0/799.0e0 ELSE 192.0e0/192.0e0 END ELSE 979.0e0/979.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/4627.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/128.0e0 ELSE 83.0e0/83.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/30.0e0 ELSE 40.0e0/40.0e0 END END END ELSE CASE WHEN tx_hour <= 22.5e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 2.0e0, 3.0e0, 4.0e0, 5.0e0) THEN 455.0e0/948.0e0 ELSE CASE WHEN is_online <= 0.5e0 THEN 44.0e0/90.0e0 ELSE 67.0e0/106.0e0 END END ELSE 67.0e0/67.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 3.0e0/814.0e0 ELSE 804.0e0/804.0e0 END ELSE 367.0e0/367.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/2401.0e0 ELSE CASE WHEN merchant_category_idx IN (0.0e0, 1.0e0, 4.0e0, 5.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/1576.0e0 ELSE 66.0e0/66.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/711.0e0 ELSE 62.0e0/62.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN amount <= 1944.7414262685925e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/240.0e0 ELSE 3.0e0/3.0e0 END ELSE 25.0e0/339.0e0 END ELSE 608.0e0/608.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 3.0e0/862.0e0 ELSE 794.0e0/794.0e0 END ELSE CASE WHEN merchant_category_idx IN (0.0e0, 4.0e0, 5.0e0) THEN CASE WHEN amount <= 6276.409954298288e0 THEN 7.0e0/1513.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/883.0e0 ELSE 43.0e0/43.0e0 END END ELSE 75.0e0/2342.0e0 END END ELSE CASE WHEN merchant_category_idx IN (0.0e0, 2.0e0, 3.0e0, 4.0e0, 5.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 150.0e0/150.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 1.0e0/460.0e0 ELSE 17.0e0/17.0e0 END END ELSE 641.0e0/641.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 37.0e0/37.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/91.0e0 ELSE 5.0e0/5.0e0 END END ELSE 169.0e0/169.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 3.0e0/838.0e0 ELSE 801.0e0/801.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/4495.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/150.0e0 ELSE 112.0e0/112.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 181.0e0/181.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 2.0e0/522.0e0 ELSE 30.0e0/30.0e0 END END ELSE 764.0e0/764.0e0 END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 2.0e0/838.0e0 ELSE 836.0e0/836.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/2377.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/2229.0e0 ELSE 116.0e0/116.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 3.0e0, 4.0e0, 5.0e0) THEN 122.0e0/498.0e0 ELSE CASE WHEN is_online <= 0.5e0 THEN CASE WHEN amount <= 2824.4428953621536e0 THEN 22.0e0/85.0e0 ELSE 34.0e0/67.0e0 END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 33.0e0/33.0e0 ELSE 6.0e0/99.0e0 END END END ELSE 852.0e0/852.0e0 END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 2.0e0, 3.0e0, 4.0e0, 5.0e0) THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 0.0e0/739.0e0 ELSE 116.0e0/116.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 0.0e0/128.0e0 ELSE 45.0e0/45.0e0 END END ELSE 1038.0e0/1038.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/4509.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/173.0e0 ELSE 117.0e0/117.0e0 END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 3.0e0, 4.0e0, 5.0e0) THEN 18.0e0/429.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 3.0e0/171.0e0 ELSE 15.0e0/15.0e0 END END ELSE 582.0e0/582.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 3.0e0/823.0e0 ELSE 773.0e0/773.0e0 END ELSE CASE WHEN amount <= 5321.41936593689e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/2440.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/129.0e0 ELSE 1.0e0/1.0e0 END END ELSE CASE WHEN amount <= 6276.409954298288e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/445.0e0 ELSE 13.0e0/13.0e0 END ELSE 90.0e0/1714.0e0 END END END ELSE CASE WHEN merchant_category_idx IN (4.0e0, 5.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN 106.0e0/106.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 175.0e0/362.0e0 ELSE 19.0e0/19.0e0 END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 127.0e0/127.0e0 ELSE 32.0e0/417.0e0 END ELSE 575.0e0/575.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 2.5e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 2.0e0/429.0e0 ELSE 63.0e0/63.0e0 END ELSE 110.0e0/499.0e0 END ELSE 1006.0e0/1006.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 6.0e0/2890.0e0 ELSE CASE WHEN merchant_category_idx IN (3.0e0, 4.0e0, 5.0e0) THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 0.0e0/77.0e0 ELSE 12.0e0/12.0e0 END ELSE 24.0e0/83.0e0 END END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN location_idx IN (0.0e0, 2.0e0, 3.0e0) THEN 66.0e0/1722.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/576.0e0 ELSE 45.0e0/45.0e0 END END ELSE 589.0e0/589.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 3.0e0/3275.0e0 ELSE CASE WHEN merchant_category_idx IN (0.0e0, 2.0e0, 4.0e0, 5.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN 468.0e0/468.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/1585.0e0 ELSE 73.0e0/73.0e0 END END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 305.0e0/305.0e0 ELSE 44.0e0/766.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 186.0e0/186.0e0 ELSE CASE WHEN is_online <= 0.5e0 THEN 29.0e0/323.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/270.0e0 ELSE 9.0e0/9.0e0 END END END ELSE 830.0e0/830.0e0 END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 3.0e0/778.0e0 ELSE 797.0e0/797.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/4548.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/165.0e0 ELSE 105.0e0/105.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN amount <= 644.2776380572468e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 12.0e0/12.0e0 ELSE 2.0e0/75.0e0 END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 167.0e0/167.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 3.0e0/487.0e0 ELSE 29.0e0/29.0e0 END END END ELSE 810.0e0/810.0e0 END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 3.0e0/845.0e0 ELSE 800.0e0/800.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/4479.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 3.0e0) THEN 41.0e0/141.0e0 ELSE CASE WHEN merchant_category_idx IN (3.0e0, 4.0e0, 5.0e0) THEN 30.0e0/70.0e0 ELSE 48.0e0/86.0e0 END END END END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 365.0e0/365.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN CASE WHEN tx_hour <= 15.5e0 THEN 373.0e0/695.0e0 ELSE 200.0e0/459.0e0 END ELSE 84.0e0/84.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 3.0e0/829.0e0 ELSE 840.0e0/840.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/4554.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/107.0e0 ELSE 74.0e0/74.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/26.0e0 ELSE 39.0e0/39.0e0 END END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN 175.0e0/175.0e0 ELSE CASE WHEN merchant_category_idx IN (1.0e0, 3.0e0, 4.0e0) THEN 11.0e0/296.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/283.0e0 ELSE 23.0e0/23.0e0 END END END ELSE 807.0e0/807.0e0 END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 0.5e0 THEN 17.0e0/137.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 3.0e0/700.0e0 ELSE 156.0e0/156.0e0 END END ELSE 1060.0e0/1060.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 38.0e0/2896.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 8122.535017319024e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/1445.0e0 ELSE 91.0e0/91.0e0 END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/866.0e0 ELSE 33.0e0/33.0e0 END END ELSE 618.0e0/618.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 1.0e0/801.0e0 ELSE 155.0e0/155.0e0 END ELSE 996.0e0/996.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/4571.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/154.0e0 ELSE 111.0e0/111.0e0 END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 5.0e0/594.0e0 ELSE 37.0e0/37.0e0 END ELSE 624.0e0/624.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN merchant_category_idx IN (0.0e0, 3.0e0, 5.0e0) THEN CASE WHEN tx_hour <= 2.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 0.0e0/255.0e0 ELSE 45.0e0/45.0e0 END ELSE 231.0e0/231.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN is_online <= 0.5e0 THEN 66.0e0/177.0e0 ELSE 129.0e0/238.0e0 END ELSE 100.0e0/100.0e0 END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 1.0e0/365.0e0 ELSE 101.0e0/101.0e0 END ELSE 564.0e0/564.0e0 END END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/4458.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/134.0e0 ELSE 120.0e0/120.0e0 END END ELSE CASE WHEN tx_hour <= 22.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/560.0e0 ELSE 585.0e0/585.0e0 END ELSE 68.0e0/68.0e0 END END END)
 + (CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN tx_hour <= 3.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 4.0e0/557.0e0 ELSE 578.0e0/578.0e0 END ELSE CASE WHEN location_idx IN (1.0e0, 2.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/151.0e0 ELSE 108.0e0/108.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/131.0e0 ELSE 118.0e0/118.0e0 END END END ELSE CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/4422.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/161.0e0 ELSE 125.0e0/125.0e0 END END END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 356.0e0/356.0e0 ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 2.0e0/533.0e0 ELSE 21.0e0/21.0e0 END ELSE 630.0e0/630.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 4.5e0 THEN CASE WHEN location_idx IN (1.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 1.0e0/358.0e0 ELSE 319.0e0/319.0e0 END ELSE 375.0e0/679.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 2.0e0, 3.0e0) THEN CASE WHEN amount <= 5018.9388485159725e0 THEN 0.0e0/108.0e0 ELSE 73.0e0/73.0e0 END ELSE CASE WHEN merchant_category_idx IN (0.0e0, 1.0e0, 2.0e0, 4.0e0, 5.0e0) THEN 25.0e0/59.0e0 ELSE 15.0e0/17.0e0 END END END ELSE 359.0e0/359.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/4576.0e0 ELSE CASE WHEN location_idx IN (3.0e0) THEN 20.0e0/68.0e0 ELSE CASE WHEN is_online <= 0.5e0 THEN 44.0e0/103.0e0 ELSE 64.0e0/115.0e0 END END END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 22.5e0 THEN 2.0e0/539.0e0 ELSE 36.0e0/36.0e0 END ELSE 570.0e0/570.0e0 END END END)
 + (CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 3.0e0/768.0e0 ELSE 167.0e0/167.0e0 END ELSE 984.0e0/984.0e0 END ELSE CASE WHEN amount <= 5018.9388485159725e0 THEN 43.0e0/2894.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN CASE WHEN merchant_category_idx IN (5.0e0) THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 0.0e0/422.0e0 ELSE 68.0e0/68.0e0 END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 0.0e0/1881.0e0 ELSE 493.0e0/493.0e0 END END ELSE 176.0e0/176.0e0 END END END)
 + (CASE WHEN amount <= 5018.9388485159725e0 THEN CASE WHEN tx_hour <= 5.5e0 THEN CASE WHEN amount <= 4373.668956104666e0 THEN CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 0.0e0/728.0e0 ELSE 148.0e0/148.0e0 END ELSE CASE WHEN merchant_category_idx IN (0.0e0, 1.0e0) THEN 4.0e0/38.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 3.0e0/60.0e0 ELSE 31.0e0/31.0e0 END END END ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN 0.0e0/2448.0e0 ELSE CASE WHEN tx_hour <= 22.5e0 THEN 2.0e0/568.0e0 ELSE 38.0e0/38.0e0 END END END ELSE CASE WHEN tx_hour <= 5.5e0 THEN 1038.0e0/1038.0e0 ELSE CASE WHEN location_idx IN (0.0e0, 1.0e0, 2.0e0, 3.0e0) THEN CASE WHEN tx_hour <= 22.5e0 THEN 0.0e0/2228.0e0 ELSE 129.0e0/129.0e0 END ELSE 647.0e0/647.0e0 END END END) AS v1
FROM (SELECT *, (CASE location WHEN 'Sfax' THEN 0e0 WHEN 'Monastir' THEN 1e0 WHEN 'Sousse' THEN 2e0 WHEN 'Tunis' THEN 3e0 WHEN 'FOREIGN_REMOTE' THEN 4e0 ELSE 5e0 END) AS location_idx, (CASE merchant_category WHEN 'TRAVEL' THEN 0e0 WHEN 'FASHION' THEN 1e0 WHEN 'ELECTRONICS' THEN 2e0 WHEN 'RESTAURANT' THEN 3e0 WHEN 'GROCERY' THEN 4e0 WHEN 'PHARMACY' THEN 5e0 ELSE 6e0 END) AS merchant_category_idx FROM tx))
