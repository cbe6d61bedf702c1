"""A small messy bookshop.

Fixed values: the rows must equal those the expected results were worked out
from.
"""

from __future__ import annotations

import datetime as dt

AS_OF = dt.date(2025, 6, 30)
LOADED = dt.datetime(2025, 6, 1)

CUSTOMERS = [
    ("C001", "Maria Silva Santos", "maria.silva@email.com", "(11) 98765-4321", "2023-01-15", "São Paulo", "SP", "Brasil", "1985-03-20"),
    ("C002", "João Pedro Oliveira", "joao@invalid", "11987654321", "2023/02/20", "Rio de Janeiro", "RJ", "Brasil", "15/04/1990"),
    ("C003", "Ana Carolina Costa", "ana.costa@email.com", None, "2023-03-10", "Belo Horizonte", "MG", "Brasil", "1992-07-08"),
    ("C004", "  Carlos Eduardo  ", "carlos.edu@email.com", "(21)99999-8888", "2023-04-05", "Rio de Janeiro", "rj", "brasil", "1988-11-30"),
    ("C001", "Maria Silva Santos", "maria.silva@email.com", "(11) 98765-4321", "2023-01-15", "São Paulo", "SP", "Brasil", "1985-03-20"),
    ("C005", "Juliana Mendes", "", "85988887777", "2023-05-12", "Fortaleza", "CE", "Brasil", "1995-02-14"),
    ("C006", "Roberto Almeida", "roberto.alm@email.com", "(31)3456-7890", "2023-06-18", "belo horizonte", "MG", "BR", "1980-09-25"),
    ("C007", "Fernanda Lima", "fernanda.lima@email.com", None, "2023-07-22", "Curitiba", "PR", "Brasil", "1993-12-05"),
    ("C008", "Paulo Henrique", "paulo@email", "48999998888", "01/08/2023", "Florianópolis", "SC", "Brasil", "1987-06-18"),
    ("C009", "Camila Rodrigues", "camila.rod@email.com", "(71)98888-7777", "2023-09-10", "Salvador", "BA", "Brasil", "1991-04-22"),
    ("C010", "Lucas Ferreira", "lucas.ferreira@email.com", "(61)99999-6666", "2023-10-05", "Brasília", "DF", "Brasil", "1989-08-30"),
]
BOOKS = [
    ("B001", "O Senhor dos Anéis: A Sociedade do Anel", "J.R.R. Tolkien", "HarperCollins", "1954", "978-0547928210", "Fantasia", "89.90", "150", "576", "PT", "4.8"),
    ("B002", "Harry Potter e a Pedra Filosofal", "J.K. Rowling", "Rocco", "1997", "978-8532530787", "fantasia", "45.50", "200", "264", "pt-br", "4.9"),
    ("B003", "1984", "George Orwell", "Companhia das Letras", "1949", "978-8535914849", "Ficção Científica", "35.00", "80", "416", "PT", "4.7"),
    ("B004", "Dom Casmurro", "Machado de Assis", "Penguin", "1899", "978-8563560179", "Literatura Brasileira", "28.90", "120", "256", "PT-BR", "4.3"),
    ("B005", "A Menina que Roubava Livros", "Markus Zusak", "Intrínseca", "2005", "978-8580573466", "FICÇÃO", "-15.50", "0", "480", "pt", "4.6"),
    ("B006", "O Hobbit", "J.R.R. Tolkien", "HarperCollins", "1937", "978-0547928227", "Fantasia", "52.00", "175", "310", "PT", "4.8"),
    ("B007", "Percy Jackson e o Ladrão de Raios", "Rick Riordan", "Intrínseca", "2005", "978-8598078355", "Fantasia", "39.90", "95", "400", "PT-BR", "4.5"),
    ("B008", "A Culpa é das Estrelas", "John Green", "Intrínseca", "2012", "978-8580572261", "Romance", "34.90", "210", "288", "pt-br", "4.4"),
    ("B009", "O Código Da Vinci", "Dan Brown", "Arqueiro", "2003", "978-8599296134", "suspense", "42.00", "60", "432", "PT", "4.2"),
    ("B010", "Orgulho e Preconceito", "Jane Austen", "Martin Claret", "1813", "978-8572327640", "Romance Clássico", "29.90", "140", "424", "PT", "4.6"),
    ("B011", "A Revolucao dos Bichos", "George Orwell", "Companhia das Letras", "3000", "978-8535909555", "Ficção", "32.00", "90", "152", "PT", "4.5"),
    ("B012", "It - A Coisa", "Stephen King", "Suma", "1986", "978-8556510594", "Terror", "79.90", "45", "1104", "PT", "4.7"),
]
ORDERS = [
    ("ORD001", "C001", "2024-01-20", "135.40", "Cartão de Crédito", "Entregue", "15.00", "10.00"),
    ("ORD002", "C002", "2024-02-15", "89.90", "PIX", "entregue", "12.00", "0"),
    ("ORD003", "C003", "2024-02-28", "174.80", "Boleto", "Em Trânsito", "18.00", "15.00"),
    ("ORD004", "C004", "2024-03-10", "63.90", "Cartão de Débito", "PROCESSANDO", "10.00", "5.00"),
    ("ORD005", "C005", "2024-03-22", "", "Cartão de Crédito", "Cancelado", None, "0"),
    ("ORD006", "C006", "2024-04-05", "156.80", "pix", "Entregue", "15.00", "20.00"),
    ("ORD007", "C007", "2025-12-30", "91.90", "Cartão de Crédito", "Entregue", "12.00", "0"),
    ("ORD008", "C008", "2024-05-18", "114.80", "PIX", "Em Trânsito", "15.00", "10.00"),
    ("ORD009", "C009", "2024-06-02", "79.90", "Boleto", "Entregue", "12.00", "0"),
    ("ORD010", "C010", "2024-06-15", "247.70", "Cartão de Crédito", "entregue", "20.00", "25.00"),
    ("ORD011", "C003", "2024-07-08", "84.00", "PIX", "Entregue", "12.00", "8.00"),
    ("ORD012", "C001", "2024-07-22", "62.00", "cartao", "Processando", "10.00", "0"),
]
ITEMS = [
    ("OI001", "ORD001", "B001", "1", "89.90", "89.90"),
    ("OI002", "ORD001", "B002", "1", "45.50", "45.50"),
    ("OI003", "ORD002", "B001", "1", "89.90", "89.90"),
    ("OI004", "ORD003", "B002", "2", "45.50", "91.00"),
    ("OI005", "ORD003", "B003", "2", "35.00", "70.00"),
    ("OI006", "ORD003", "B004", "1", "28.90", "28.90"),
    ("OI007", "ORD004", "B003", "1", "35.00", "35.00"),
    ("OI008", "ORD004", "B004", "1", "28.90", "28.90"),
    ("OI009", "ORD006", "B006", "2", "52.00", "104.00"),
    ("OI010", "ORD006", "B007", "1", "39.90", "39.90"),
    ("OI011", "ORD006", "B008", "1", "34.90", "34.90"),
    ("OI012", "ORD007", "B009", "2", "42.00", "84.00"),
    ("OI013", "ORD007", "B010", "1", "29.90", "29.90"),
    ("OI014", "ORD008", "B001", "1", "89.90", "89.90"),
    ("OI015", "ORD008", "B004", "1", "28.90", "28.90"),
    ("OI016", "ORD009", "B012", "1", "79.90", "79.90"),
    ("OI017", "ORD010", "B012", "2", "79.90", "159.80"),
    ("OI018", "ORD010", "B001", "1", "89.90", "89.90"),
    ("OI019", "ORD010", "B003", "1", "35.00", "35.00"),
    ("OI020", "ORD011", "B006", "1", "52.00", "52.00"),
    ("OI021", "ORD011", "B007", "1", "39.90", "39.90"),
    ("OI022", "ORD012", "B010", "2", "29.90", "59.80"),
]
REVIEWS = [
    ("R001", "B001", "C001", "5", "Obra-prima da fantasia! Simplesmente incrível.", "2024-02-01", "45"),
    ("R002", "B001", "C002", "5", "Melhor livro que já li!", "2024-02-18", "32"),
    ("R003", "B002", "C003", "5", "Magia pura! Adorei cada página.", "2024-03-05", "28"),
    ("R004", "B002", "C004", "4", "Muito bom, mas achei o ritmo lento no início.", "2024-03-15", "15"),
    ("R005", "B003", "C003", "5", "Distopia aterrorizante e atual. Recomendo!", "2024-03-20", "52"),
    ("R006", "B003", "C004", "12", "Excelente reflexão sobre totalitarismo.", "2024-04-01", "38"),
    ("R007", "B004", "C006", "4", "Clássico da literatura brasileira. Vale a leitura.", "01-05-2024", "22"),
    ("R008", "B006", "C006", "5", "Aventura fantástica! Prelúdio perfeito.", "2024-05-10", "41"),
    ("R009", "B012", "C009", "5", "Stephen King é mestre do terror!", "2024-06-08", "67"),
    ("R010", "B001", "C010", "5", "Releitura anual garantida.", "2024-06-20", "19"),
    ("R011", "B009", "C007", "-2", "Não gostei do final.", "2024-08-15", "3"),
    ("R012", "B010", "C010", "4", "Romance clássico bem escrito.", "invalid-date", "12"),
]
