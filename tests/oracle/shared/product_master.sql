SELECT goods.codprod, goods.descricao AS produto, maker.codfornec, maker.fornecedor, maker.classificacao AS class_code,
       COALESCE(class_names.title_name, 'Outros') AS classificacao, maker.codcomprador, buyer.nome AS comprador,
       area.departamento, area.secao, area.categoria
FROM pcprodut AS goods
JOIN pcfornec AS maker USING (codfornec)
LEFT JOIN class_names ON class_names.code = maker.classificacao
LEFT JOIN pcempr AS buyer ON buyer.matricula = maker.codcomprador
LEFT JOIN product_area AS area USING (codprod)
